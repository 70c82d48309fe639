"""Near-duplicates by circulant MinHash, banding and exact Jaccard verification.

Sketch: one permutation sigma scatters the shingles over Z/2^32; all coordinates come from a
second permutation pi that is shifted circularly, h_k = min pi(sigma(x) - k) (Li & Li 2022).
Equal sets are grouped first; one representative of each set is banded.  A ``Rule`` has the width of
shingles and the threshold J; as many bands of 4 coordinates are taken as make a pair at the
threshold share no band with a probability, (1 - J^4)^bands, of at most 5e-7: 20 at 0.85, 28 at 0.8.

Candidates never expand into all pairs of a bucket.  First a bucket tests its members against
one centre (the member that meets most others over all its bands); links are confirmed on the
full shingle sets, and components are contracted.  A bucket whose members are all in one
component is finished.  Members of the others get a long sketch (2048 coordinates of the same
circulant family, one bit each).  A bucket is cut into blocks of about 512 members, and each pair of
its blocks is a group of rows; within it the pairs in different components are compared by that sketch, and
only those it cannot exclude leave the task for the exact test.  So no
link between different texts is lost, and a large group of copies that differ more than the
threshold gives few rows, is spread over many tasks and costs a few array steps a pair.  The filters exclude pairs whose short sketch lies 7, or whose long sketch
lies 5, standard deviations below the threshold (at 0.85: under 46 of 80 equal coordinates where 68 are
expected, over 213 of 2048 differing bits where 154 are expected); sizes that exclude the threshold are left out too.

Words: A-Z lower-cased, `[^\\x20\\x09-\\x0D]+`; a set holds the distinct 64-bit hashes of the
rule's shingles (3 or 5 words), or of the whole sequence when the text has fewer words.

A node is a set of shingles, that is, all rows whose sets are equal; a doc_id that holds several
texts links the nodes of these texts with each other.  ``deduplicate`` leaves such links out: it drops
a row only for the sake of its own text.

Defined results: a null or empty text has an empty set and is linked with nothing; a row without
doc_id is linked with nothing, has a null component_id and is kept; an empty table gives an empty
result; other columns, whatever their names, are ignored (``deduplicate`` carries them).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.llm.bytewords import WordHasher, mix64, space_words, text_chunks
from callweave.llm.common import join_counted, materialize, read_columns, text_key
from callweave.llm.components import connected_components

#: coordinates of a band, and of the long sketch
ROWS, LONG = 4, 2048
#: probability that a pair at the threshold shares no band
MAX_MISS = 5e-7
#: bits of the filter that keeps texts without a candidate out of the shuffle: 16 for a candidate, within
#: these bounds (32 MB at most); what it lets through is sorted out by a join
MIN_FILTER_BITS, MAX_FILTER_BITS = 1 << 20, 1 << 28
#: pairs of one set that are compared with one copy of it
PAIRS_PER_COPY = 1024
#: members of an open bucket that are compared as one block, and pairs that a task holds at once
BLOCK, PAIRS_AT_ONCE = 512, 1 << 15

#: a row's doc_id and the key of its text
KEY = ["doc_id", "k1", "k2"]
SKETCH_SCHEMA = ("doc_id long, k1 long, k2 long, n_shingles long, fp1 long, fp2 long, bands array<bigint>, "
                 "sig binary")


@dataclass(frozen=True)
class Rule:
    """Texts are alike if 100 * shared >= percent * united shingles of ``width`` words; what follows from that."""

    width: int
    percent: int

    def __post_init__(self):
        if self.width < 1 or not 50 <= self.percent <= 100:
            raise ValueError(f"shingles of at least one word and a threshold of 50 to 100 percent, not {self}")

    @property
    def bands(self) -> int:
        return max(1, math.ceil(math.log(MAX_MISS) / math.log1p(-(self.percent / 100) ** ROWS))) if self.percent < 100 else 1

    @property
    def coordinates(self) -> int:
        return self.bands * ROWS

    @property
    def min_equal(self) -> int:
        j, n = self.percent / 100, self.coordinates
        return round(n * j - 7 * math.sqrt(n * j * (1 - j)))

    @property
    def max_differing(self) -> int:
        p = (1 - self.percent / 100) / 2
        return int(LONG * p + 5 * math.sqrt(LONG * p * (1 - p)))


#: the rule of ``near_duplicate_classes``' query, and the one of stages on word shingles
CLASSES = Rule(3, 85)
FIVE_WORDS = Rule(5, 80)


# --- sets and sketches ----------------------------------------------------------------------
def shingle_sets(hasher: WordHasher, data: np.ndarray, offs: np.ndarray, width: int = CLASSES.width) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a chunk."""
    starts, ends, first = hasher.bounds(data, offs)
    w = hasher.hashes(data, starts, ends)
    mult = mix64(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    full = max(0, len(w) - width + 1)
    s = np.zeros(full, dtype=np.uint64)
    for j in range(width):
        s += w[j:j + full] * mult[j]
    s = mix64(s)
    out = []
    for i in range(len(offs) - 1):
        lo, hi = int(first[i]), int(first[i + 1])
        if hi - lo >= width:
            v = np.sort(s[lo:hi - width + 1])
            new = np.ones(len(v), dtype=bool)
            new[1:] = v[1:] != v[:-1]
            out.append(v[new])
        elif hi > lo:
            whole = (w[lo:hi] * mult[:hi - lo]).sum(dtype=np.uint64) + np.uint64(hi - lo)
            out.append(mix64(np.array([whole], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def circulant_signature(values: np.ndarray, at: np.ndarray, k: int = CLASSES.coordinates) -> np.ndarray:
    """(sets, k) uint32: coordinate j is the least pi(sigma(x) - j) over the set.

    ``values`` concatenates non-empty sets, ``at`` are their first indices.  The shingle hash
    supplies sigma; pi is the 32-bit finaliser of MurmurHash3 (public domain), a bijection."""
    sigma = (values >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(at), k), dtype=np.uint32)
    x, t = np.empty_like(sigma), np.empty_like(sigma)
    for j in range(k):
        np.subtract(sigma, np.uint32(j + 1), out=x)
        for shift, mult in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, None)):
            np.right_shift(x, np.uint32(shift), out=t)
            np.bitwise_xor(x, t, out=x)
            if mult is not None:
                np.multiply(x, np.uint32(mult), out=x)
        out[:, j] = np.minimum.reduceat(x, at)
    return out


def band_keys(sig: np.ndarray, bands: int) -> np.ndarray:
    rows = sig.shape[1] // bands
    s = sig.astype(np.uint64).reshape(len(sig), bands, rows)
    h = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), s.shape[:2]).copy()
    for r in range(rows):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + s[:, :, r])
    return h.view(np.int64)


def _sketch(rule: Rule) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(space_words(), lower=True)
        for batch in batches:
            for lo, hi, data, offs in text_chunks(batch.column("text")):
                sets = shingle_sets(hasher, data, offs, rule.width)
                n = np.array([len(s) for s in sets], dtype=np.int64)
                full = np.flatnonzero(n)
                fp1, fp2 = np.zeros(hi - lo, dtype=np.uint64), np.zeros(hi - lo, dtype=np.uint64)
                keys: list = [None] * (hi - lo)
                sigs: list = [None] * (hi - lo)
                if len(full):
                    values = np.concatenate([sets[i] for i in full])
                    at = np.cumsum(n[full]) - n[full]
                    fp1[full] = np.add.reduceat(mix64(values), at)
                    fp2[full] = np.bitwise_xor.reduceat(mix64(~values), at)
                    sig = circulant_signature(values, at, rule.coordinates)
                    bands, short = band_keys(sig, rule.bands), sig.astype(np.uint8)
                    for k, i in enumerate(full):
                        keys[i], sigs[i] = bands[k], short[k].tobytes()
                key = [batch.column(c).slice(lo, hi - lo) for c in KEY]
                yield pa.RecordBatch.from_arrays([
                    *key, pa.array(n, pa.int64()), pa.array(fp1.view(np.int64), pa.int64()),
                    pa.array(fp2.view(np.int64), pa.int64()), pa.array(keys, pa.list_(pa.int64())),
                    pa.array(sigs, pa.binary())], names=[*KEY, "n_shingles", "fp1", "fp2", "bands", "sig"])

    return rows


def sketch(docs: DataFrame, rule: Rule = CLASSES) -> DataFrame:
    """doc_id, a key of the text, n_shingles, a 128-bit set fingerprint, band keys and the signature's low bytes."""
    return _texts(docs).mapInArrow(_sketch(rule), SKETCH_SCHEMA)


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return read_columns(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), *text_key(text), text.alias("text"))


# --- full sets of candidates ------------------------------------------------------------------
def _filter_bits(ids: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    h = mix64(ids.astype(np.int64).view(np.uint64))
    return h % np.uint64(bits), (h >> np.uint64(32)) % np.uint64(bits)


def row_filter(rows: DataFrame, bits: int) -> np.ndarray:
    """Bloom filter (two hashes) of ``bits`` bits over a long column ``h``, whatever its length."""
    def words(batches):
        for b in batches:
            v = b.column("h").to_numpy(zero_copy_only=False)
            x = np.unique(np.concatenate(_filter_bits(v, bits)))
            at, first = np.unique(x >> np.uint64(6), return_index=True)
            if len(at):
                w = np.bitwise_or.reduceat(np.uint64(1) << (x & np.uint64(63)), first)
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(w.view(np.int64))],
                                                 names=["at", "w"])

    got = rows.select("h").mapInArrow(words, "at long, w long").groupBy("at").agg(F.bit_or("w").alias("w")).toPandas()
    out = np.zeros(bits >> 6, dtype=np.uint64)
    out[got["at"].to_numpy(dtype=np.int64)] = got["w"].to_numpy(dtype=np.int64).view(np.uint64)
    return out


def candidate_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(id, members): the full sorted shingle set of every node in ``wanted`` (id and the key of one of its rows)."""
    spark = docs.sparkSession
    hashed = F.xxhash64(*KEY)
    size = wanted.count()
    bits = min(MAX_FILTER_BITS, max(MIN_FILTER_BITS, 1 << (16 * size).bit_length()))
    shared = spark.sparkContext.broadcast(row_filter(wanted.select(hashed.alias("h")), bits))

    def sets(batches):
        hasher = WordHasher(space_words(), lower=True)
        bloom = shared.value
        for batch in batches:
            a, b = _filter_bits(batch.column("h").to_numpy(zero_copy_only=False), bits)
            got = [(bloom[x >> np.uint64(6)] >> (x & np.uint64(63))) & np.uint64(1) for x in (a, b)]
            batch = batch.filter(pa.array((got[0] & got[1]).astype(bool)))
            for lo, hi, data, offs in text_chunks(batch.column("text")):
                found = shingle_sets(hasher, data, offs, width)
                yield pa.RecordBatch.from_arrays([
                    *[batch.column(c).slice(lo, hi - lo) for c in KEY],
                    pa.array([s.tobytes() for s in found], pa.binary())], names=[*KEY, "members"])

    found = _texts(docs).filter("doc_id IS NOT NULL").withColumn("h", hashed) \
        .mapInArrow(sets, "doc_id long, k1 long, k2 long, members binary")
    # repeated rows are merged in their tasks before anything is moved
    return found.groupBy(*KEY).agg(F.first("members").alias("members")).join(wanted, KEY).select("id", "members")


def _overlaps(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        both = []
        for x, y in zip(b.column("ma"), b.column("mb")):
            p = np.frombuffer(x.as_py(), dtype=np.uint64)
            q = np.frombuffer(y.as_py(), dtype=np.uint64)
            if len(p) > len(q):
                p, q = q, p
            i = np.minimum(np.searchsorted(q, p), len(q) - 1) if len(q) else np.zeros(0, dtype=np.int64)
            both.append((int((q[i] == p).sum()) if len(q) else 0, len(p) + len(q)))
        shared = np.array([s for s, _ in both], dtype=np.int64)
        total = np.array([t for _, t in both], dtype=np.int64)
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(shared), pa.array(total - shared)],
                                         names=["a", "b", "shared", "united"])


def _alike(least: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = np.frombuffer(b"".join(b.column("sa").to_pylist()), dtype=np.uint8).reshape(b.num_rows, -1)
            y = np.frombuffer(b"".join(b.column("sb").to_pylist()), dtype=np.uint8).reshape(b.num_rows, -1)
            yield b.select(["a", "b"]).filter(pa.array((x == y).sum(axis=1) >= least))

    return pairs


def _alike_pairs(pairs: DataFrame, sigs: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b) that the short sketches cannot exclude; ``a``, a centre, may be in most of them."""
    counts = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("pairs"))
    sa = materialize(counts.join(sigs.select(F.col("id").alias("a"), F.col("sig").alias("sa")), "a"), "centres")
    sb = sigs.select(F.col("id").alias("b"), F.col("sig").alias("sb"))
    return join_counted(pairs, sa, ["a"], "pairs").join(sb, "b").select("a", "b", "sa", "sb") \
        .mapInArrow(_alike(least), "a long, b long")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = CLASSES.percent) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold: 100 * shared >= percent * united.

    ``pairs`` is a written table.  The set of an ``a`` with many pairs is copied, once for ``PAIRS_PER_COPY`` of
    them (and never more than 65,536 times), so a centre's pairs are spread over that many keys."""
    total = pairs.count()
    counts = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("pairs")) \
        .withColumn("copies", F.ceil(F.col("pairs") / F.lit(max(PAIRS_PER_COPY, total >> 16))))
    counts = materialize(counts, "pair_counts")
    spread = join_counted(pairs, counts, ["a"], "pairs") \
        .withColumn("copy", F.pmod(F.xxhash64("b"), F.col("copies")))
    ma = sets.select(F.col("id").alias("a"), F.col("members").alias("ma")).join(counts, "a") \
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).select("a", "copy", "ma")
    mb = sets.select(F.col("id").alias("b"), F.col("members").alias("mb"))
    return spread.select("a", "b", "copy").join(ma, ["a", "copy"]).join(mb, "b").select("a", "b", "ma", "mb") \
        .mapInArrow(_overlaps, "a long, b long, shared long, united long") \
        .filter(F.col("shared") * 100 >= F.col("united") * percent).select("a", "b")


# --- candidate rounds -------------------------------------------------------------------------
def _buckets(reps: DataFrame) -> DataFrame:
    """(key, band, id, n, degree): members of buckets with two or more sets; degree counts an id's meetings."""
    rows = reps.select("id", "n", F.posexplode("bands").alias("band", "key"))
    shared = materialize(rows.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), "bucket_sizes")
    met = materialize(join_counted(rows, shared, ["key"], "c"), "buckets")
    degree = met.groupBy("id").agg(F.sum("c").alias("degree"))
    return materialize(met.join(degree, "id").select("key", "band", "id", "n", "degree"), "buckets")


def _size_fits(n: str, m: str, percent: int):
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def _star_pairs(buckets: DataFrame, percent: int) -> DataFrame:
    """Pairs (centre, other) of each bucket's centre, the member of the highest degree, with its other members."""
    centre = buckets.groupBy("key").agg(F.max(F.struct("degree", (-F.col("id")).alias("neg"), "n")).alias("c"),
                                        F.count(F.lit(1)).alias("size")) \
        .select("key", (-F.col("c.neg")).alias("centre"), F.col("c.n").alias("cn"), "size")
    return join_counted(buckets, materialize(centre, "bucket_centres"), ["key"], "size") \
        .filter("id <> centre").filter(_size_fits("n", "cn", percent)) \
        .select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct()


def _open_members(buckets: DataFrame, comp: DataFrame) -> DataFrame:
    """Members, with their components and the bucket's size, of the buckets that are still in two components."""
    named = materialize(buckets.join(comp, "id", "left").select("key", "band", "id", "n", F.coalesce(
        "component", "id").alias("comp")), "bucket_components")
    mixed = named.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                     F.count(F.lit(1)).alias("size")).filter("lo <> hi")
    return materialize(named.join(mixed.select("key", "size"), "key"), "open_buckets")


def _long_bits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, bands, bits): the lowest bit of LONG coordinates, as 64-bit words."""
    for batch in batches:
        ids, values = batch.column("id").to_pylist(), batch.column("members")
        for lo in range(0, batch.num_rows, 200):
            sets = [np.frombuffer(v.as_py(), dtype=np.uint64) for v in values.slice(lo, 200)]
            at = np.concatenate(([0], np.cumsum([len(x) for x in sets])))[:-1]
            sig = circulant_signature(np.concatenate(sets), at, LONG) & np.uint32(1)
            words = np.packbits(sig.astype(np.uint8), axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids[lo:lo + 200], pa.int64()), batch.column("bands").slice(lo, 200),
                                              pa.array(list(words), pa.list_(pa.int64()))], names=["id", "bands", "bits"])


def _block_rows(members: DataFrame) -> DataFrame:
    """Members once for every pair (i, j), i <= j, of blocks of their bucket that holds theirs; side 1 is block j of two."""
    blocks = F.ceil(F.col("size") / F.lit(BLOCK))
    rows = members.withColumn("own", F.pmod(F.xxhash64("id"), blocks)) \
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    return rows.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                       (F.col("own") > F.col("other")).cast("int").alias("side"), "band", "id", "n", "comp", "bands", "bits")


def _compare(rows: pa.RecordBatch, starts: np.ndarray, rule: Rule) -> Iterator[pa.RecordBatch]:
    """The pairs of the groups that begin at ``starts``: of members of one block, or of one block with the other."""
    ids, n, comp, band, i, j, side = (rows.column(c).to_numpy() for c in ("id", "n", "comp", "band", "i", "j", "side"))
    # unsigned, as bitwise_count takes the absolute value
    bands, bits = (rows.column(c).flatten().to_numpy().view(np.uint64).reshape(rows.num_rows, -1) for c in ("bands", "bits"))
    ends = np.append(starts[1:], rows.num_rows)
    sizes = ends - starts
    other = np.repeat(starts + np.add.reduceat(side == 0, starts, dtype=np.int64), sizes)
    first = np.where(i == j, np.arange(rows.num_rows) + 1, other)
    counts = np.where(side == 0, np.repeat(ends, sizes) - first, 0)
    upto = np.cumsum(counts)
    lo = 0
    while lo < rows.num_rows:
        hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] - counts[lo] + PAIRS_AT_ONCE, "right")))
        c = counts[lo:hi]
        x = np.repeat(np.arange(lo, hi), c)
        y = np.repeat(first[lo:hi] - (np.cumsum(c) - c), c) + np.arange(len(x))
        lo = hi
        fits = (comp[x] != comp[y]) & (np.minimum(n[x], n[y]) * 100 >= np.maximum(n[x], n[y]) * rule.percent)
        x, y = x[fits], y[fits]
        # a pair is taken in the first band that it shares
        before = np.arange(bands.shape[1]) < band[x][:, None]
        fits = ~((bands[x] == bands[y]) & before).any(axis=1)
        x, y = x[fits], y[fits]
        fits = np.bitwise_count(bits[x] ^ bits[y]).sum(axis=1, dtype=np.int64) <= rule.max_differing
        a, b = ids[x[fits]], ids[y[fits]]
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def _near_pairs(rule: Rule) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The pairs that the long sketch cannot exclude, of rows sorted by key, i, j and side."""
    def pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last group, which the next batch may go on with
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch if held is None else pa.concat_batches([held, batch])
            group = np.stack([rows.column(c).to_numpy() for c in ("key", "i", "j")])
            starts = np.concatenate(([0], np.flatnonzero((group[:, 1:] != group[:, :-1]).any(axis=0)) + 1))
            held = rows.slice(starts[-1])
            if len(starts) > 1:
                yield from _compare(rows.slice(0, starts[-1]), starts[:-1], rule)
        if held is not None:
            yield from _compare(held, np.zeros(1, dtype=np.int64), rule)

    return pairs


def _rest_pairs(members: DataFrame, reps: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of a bucket that are in two components and that the long sketch cannot exclude.

    A pair is taken in the first band that it shares, and so once."""
    ids = members.select("id").distinct()
    bits = materialize(sets.join(ids, "id", "left_semi").join(reps.select("id", "bands"), "id").select("id", "bands", "members")
                       .mapInArrow(_long_bits, "id long, bands array<bigint>, bits array<bigint>"), "long_sketch")
    group = ["key", "i", "j"]
    return _block_rows(members.join(bits, "id")).repartition(*group).sortWithinPartitions(*group, "side") \
        .mapInArrow(_near_pairs(rule), "a long, b long")


def _classes(docs: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows without words or id, members, links).

    members: (doc_id, k1, k2, n_shingles, node, copies, rep), one for every other row; ``copies`` rows have the
    node's set, ``rep`` is their smallest doc_id.  links: (id, component) of the nodes linked by text."""
    rows = materialize(sketch(docs, rule), "sketch")
    valued = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    fp = ["n_shingles", "fp1", "fp2"]
    groups = valued.groupBy(*fp).agg(F.min(F.struct(*KEY)).alias("row"), F.count(F.lit(1)).alias("copies"),
                                     F.first("bands").alias("bands"), F.first("sig").alias("sig"))
    # numbered in the written table, so the numbers stay
    groups = materialize(groups.withColumn("node", F.monotonically_increasing_id()), "equal_sets")
    members = join_counted(valued.select(*KEY, *fp), groups.select(
        *fp, "node", "copies", F.col("row.doc_id").alias("rep")), fp, "copies")
    members = materialize(members.select(*KEY, "n_shingles", "node", "copies", "rep"), "members")
    reps = groups.select(F.col("node").alias("id"), F.col("n_shingles").alias("n"), "bands", "sig",
                         *[F.col(f"row.{c}").alias(c) for c in KEY])
    return rows.filter("n_shingles = 0 OR doc_id IS NULL"), members, components_of(docs, reps, rule)


def near_duplicate_classes(docs: DataFrame, rule: Rule = CLASSES) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text)."""
    rest, members, comp = _classes(docs, rule)
    nodes = members.groupBy("node").agg(F.min("rep").alias("rep"), F.max("copies").alias("copies"))
    named = materialize(nodes.join(comp, F.col("node") == F.col("id"), "left")
                        .select("node", "rep", "copies", F.coalesce("component", "node").alias("component")), "nodes")
    # the texts of one doc_id belong together: link the components of the nodes that hold it
    place = join_counted(members.select("doc_id", "node"), named.select("node", "component", "copies"), ["node"], "copies") \
        .select("doc_id", "component").distinct()
    shared = place.groupBy("doc_id").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi")
    ties = materialize(place.join(shared, "doc_id").filter("component <> lo")
                       .select(F.col("lo").alias("a"), F.col("component").alias("b")).distinct(), "shared_ids")
    if not ties.isEmpty():
        wide = connected_components(ties).select(F.col("id").alias("component"), F.col("component").alias("wide"))
        named = materialize(named.join(wide, "component", "left").select(
            "node", "rep", "copies", F.coalesce("wide", "component").alias("component")), "nodes")
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"), F.count(F.lit(1)).alias("nodes"))
    named = materialize(join_counted(named, materialize(least, "components"), ["component"], "nodes")
                        .select("node", "copies", "component_id"), "nodes")
    out = join_counted(members.select("doc_id", "n_shingles", "node"), named, ["node"], "copies")
    alone = rest.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return out.select("doc_id", "n_shingles", "component_id").unionByName(alone)


def components_of(docs: DataFrame, reps: DataFrame, rule: Rule = CLASSES) -> DataFrame:
    """(id, component) of the representatives that are linked with another one."""
    buckets = _buckets(reps)
    wanted = materialize(reps.select("id", *KEY).join(buckets.select("id").distinct(), "id"), "wanted")
    sets = materialize(candidate_sets(docs, wanted, rule.width), "sets")
    stars = materialize(_star_pairs(buckets, rule.percent), "pairs")
    near = materialize(_alike_pairs(stars, reps.select("id", "sig"), rule.min_equal), "alike")
    links = materialize(confirmed(near, sets, rule.percent), "links")
    comp = connected_components(links)
    open_ = _open_members(buckets, comp)
    tried = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rest = materialize(_rest_pairs(open_, reps, sets, rule).join(tried, ["a", "b"], "left_anti"), "pairs")
    more = materialize(confirmed(rest, sets, rule.percent), "links")
    return comp if more.isEmpty() else connected_components(links.unionByName(more))


def deduplicate(docs: DataFrame, rule: Rule = FIVE_WORDS) -> DataFrame:
    """``docs`` with one row of each class of texts that are linked with each other.

    A class is what the links between texts join; that of the smallest doc_id stays (of its several
    texts or rows, one by a fixed order).  A doc_id that holds several unlinked texts keeps them all.
    All columns are kept; rows without words or without doc_id stay."""
    _, members, comp = _classes(docs, rule)
    firsts = members.groupBy("node").agg(F.min(F.struct(*KEY)).alias("row"))
    firsts = firsts.join(comp, F.col("node") == F.col("id"), "left") \
        .groupBy(F.coalesce("component", "node").alias("component")).agg(F.min("row").alias("row"))
    stay = materialize(firsts.select(*[F.col(f"row.{c}").alias(f"_dedupe_{c}") for c in KEY]), "staying")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # the row travels as one column, so its own names cannot clash with the keys
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text.alias("text"),
                      F.col("doc_id").cast("long").alias("_dedupe_doc_id"))
    has_words = F.col("text").rlike("[^\\x20\\x09-\\x0D]") & F.col("_dedupe_doc_id").isNotNull()
    alone = row.filter(~has_words).select("row")
    keys = [f"_dedupe_{c}" for c in KEY]
    one = row.filter(has_words).select("row", "_dedupe_doc_id", *[k.alias(f"_dedupe_k{i}") for i, k in enumerate(text_key(F.col("text")), 1)]) \
        .groupBy(*keys).agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row")).join(stay, keys, "left_semi").select("row")
    return one.unionByName(alone).select("row.*")
