"""Substring duplicates by relative Lempel-Ziv parsing against distributed reference blocks.

A window is ``width`` consecutive words.  Every window selects an anchor: its k-words with the least hash (k
a third of the width), so equal windows select equal anchors at equal offsets.  A *reference block* is
the stretch of words that the windows around one anchor occurrence can reach; its index
entry is (hash of the anchor, hash of the block).  The index holds every block of every text whose
anchor occurs more than once; other text can be copied from nowhere.

A text is parsed from left to right.  Where its block has another occurrence, the block is copied
from there, and the factor is extended greedily for as long as the following blocks
continue the same source at the same distance.  Blocks are at least a window long, so every factor
is long enough to be a duplicate span.  At factor boundaries, where an anchor is known but its block is not, the windows
around the anchor are looked up one by one in the windows of all reference blocks of that anchor, so
a match that a greedy factor cuts off is still found: the result is exactly the set of words
covered by a window that starts anywhere else, too.

Scale: equal texts are merged first (a text that occurs twice is covered by itself); anchors are about
2/25 of the words; all tables are keyed by hashes and joined by key, and keys that hold more than
1/4096 of the rows (a passage in a third of all texts) are joined by a broadcast of fewer than
4,096 rows.  Only windows at boundaries are ever listed singly, and a block that many texts share is listed
once.  Windows are compared by 128 bits of hash, texts by 120 bits of MD5.

Defined results: null counts as an empty text; texts shorter than a window lose nothing; repeated
rows each keep their row and count as copies of each other; null and repeated ids are allowed; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.llm.bytewords import WordHasher, mix64, space_words, text_chunks
from callweave.llm.common import join_counted, materialize, read_columns, text_key
from callweave.session import discard

WIDTH = 35
#: words that are hashed at once; longer texts are worked on in overlapping stretches
STRETCH = 1 << 19
_BASE = np.uint64(0xD6E8FEB86659FD93)
_BASE_INV = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
_POS_BITS = 30
_SOURCE_MASK = (1 << 33) - 1
FACTOR = "struct<start:bigint,length:bigint,source:bigint,source_start:bigint>"
RANGE = "struct<first:bigint,end:bigint>"


# --- one stretch of words ----------------------------------------------------------------------
class Intervals:
    """Hashes of word intervals of ``h`` (64-bit word hashes) by prefix sums."""

    _powers = np.ones(1, dtype=np.uint64)
    _inverse = np.ones(1, dtype=np.uint64)

    def __init__(self, h: np.ndarray):
        if len(Intervals._powers) < len(h) + 1:
            steps = np.full(len(h) + 1, _BASE)
            steps[0] = 1
            Intervals._powers = np.cumprod(steps)
            steps[1:] = _BASE_INV
            Intervals._inverse = np.cumprod(steps)
        self.sums = np.zeros(len(h) + 1, dtype=np.uint64)
        np.cumsum(h * Intervals._powers[:len(h)], out=self.sums[1:])

    def __call__(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[first]) * Intervals._inverse[first] + (end - first).astype(np.uint64))


def slide(fn, x: np.ndarray, width: int) -> np.ndarray:
    """fn over every run of ``width`` values, by doubling."""
    size = 1
    while size * 2 <= width:
        x = fn(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return fn(x[:len(x) - rest], x[rest:]) if rest else x


def anchor_words(width: int) -> int:
    return max(1, width // 3)


def anchors(h: np.ndarray, lo: np.ndarray, hi: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, anchor hash, block hash) of the anchors in a stretch of word hashes.

    ``lo`` and ``hi`` are the bounds of each word's text, in positions of the stretch (they may lie
    outside of it).  Of equal least hashes in a window all are anchors."""
    k, n = anchor_words(width), len(h)
    reach = width - k
    if n < width:
        none = np.zeros(0, dtype=np.int64)
        return none, none.view(np.uint64), none.view(np.uint64)
    of = Intervals(h)
    at = np.arange(n - k + 1)
    gram = of(at, at + k) | np.uint64(1)
    least = slide(np.minimum, gram, reach + 1)
    starts = np.arange(n - width + 1)
    least = np.where(starts + width <= hi[:len(starts)], least, np.uint64(0))
    edge = np.zeros(reach, dtype=np.uint64)
    p = np.flatnonzero(slide(np.maximum, np.concatenate((edge, least, edge)), reach + 1) == gram)
    first = np.maximum(np.maximum(lo[p], p - reach), 0)
    end = np.minimum(np.minimum(hi[p], p + width), n)
    block = mix64(of(first, end) + (p - first).astype(np.uint64) * _BASE)
    return p, gram[p], block


def text_anchors(h: np.ndarray, first: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, position in the text, anchor, block) for the texts that begin at ``first`` in ``h``."""
    count = np.diff(first)
    text = np.repeat(np.arange(len(count)), count)
    margin = 2 * width
    for a in range(0, len(h), STRETCH):
        x0, x1 = max(0, a - margin), min(len(h), a + STRETCH + margin)
        t = text[x0:x1]
        p, gram, block = anchors(h[x0:x1], first[t] - x0, first[t + 1] - x0, width)
        own = (p + x0 >= a) & (p + x0 < a + STRETCH)
        p, t = p[own] + x0, t[p[own]]
        yield t, p - first[t], gram[own], block[own]


def window_hashes(h: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of the windows at ``starts`` (ascending)."""
    one, two = np.empty(len(starts), dtype=np.uint64), np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        lo = int(starts[i])
        j = int(np.searchsorted(starts, lo + STRETCH))
        s = starts[i:j] - lo
        of = Intervals(h[lo:lo + STRETCH + width])
        half = width // 2
        one[i:j] = of(s, s + width)
        two[i:j] = mix64(of(s, s + half) * _BASE + of(s + half, s + width))
        i = j
    return one, two


def merge_ranges(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of ranges as disjoint ascending ranges."""
    if not len(first):
        return first, end
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(end[order])
    new = np.concatenate(([True], first[1:] > reach[:-1]))
    return first[new], reach[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(first) - 1]))]


def parse(n: int, pos: np.ndarray, source: np.ndarray, width: int) -> list[tuple[int, int, int, int]]:
    """Factors (start, length, source, source start) of a text of ``n`` words.

    ``pos`` are the anchors (ascending) whose blocks occur elsewhere, ``source`` the addresses of these
    other occurrences.  A factor goes on while the next block continues it without a gap."""
    reach = width - anchor_words(width)
    out: list[list[int]] = []
    for p, address in zip(pos.tolist(), source.tolist()):
        text, at = address >> _POS_BITS, address & ((1 << _POS_BITS) - 1)
        first, end = max(0, p - reach), min(n, p + width)
        if out and out[-1][2] == text and out[-1][3] - out[-1][0] == at - p and first <= out[-1][0] + out[-1][1]:
            out[-1][1] = end - out[-1][0]
        else:
            out.append([first, end - first, text, at - (p - first)])
    return [tuple(f) for f in out]


def kept_words(text: bytes, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, end: np.ndarray) -> bytes:
    """The words outside the disjoint ascending word ranges, joined by one space."""
    pieces = []
    for a, b in zip([0, *end.tolist()], [*first.tolist(), len(starts)]):
        for lo in range(a, b, STRETCH):
            hi = min(b, lo + STRETCH)
            pieces.append(b" ".join(text[starts[lo]:ends[hi - 1]].split()))
    return b" ".join(pieces)


# --- tables ----------------------------------------------------------------------------------
def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return read_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), *text_key(text))


def distinct_texts(docs: DataFrame) -> DataFrame:
    """(k1, k2, text, copies, doc_id): one row per text, written; ``doc_id`` is that of the only copy."""
    return materialize(_keyed(docs).groupBy("k1", "k2").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"),
                                                            F.min("doc_id").alias("doc_id")), "texts")


def block_index(texts: DataFrame, width: int) -> DataFrame:
    """(anchor, block, k1, k2, address, copies) of every anchor of every text."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(space_words(), lower=False)
        names = ["anchor", "block", "k1", "k2", "address", "copies"]
        for batch in batches:
            k1, k2, copies = (np.asarray(batch.column(c)) for c in ("k1", "k2", "copies"))
            for lo, hi, data, offs in text_chunks(batch.column("text")):
                starts, ends, first = hasher.bounds(data, offs)
                for t, pos, anchor, block in text_anchors(hasher.hashes(data, starts, ends), first, width):
                    t = t + lo
                    address = ((k1[t] & _SOURCE_MASK) << _POS_BITS) | pos
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (
                        anchor.view(np.int64), block.view(np.int64), k1[t], k2[t], address, copies[t])], names=names)

    return texts.select("k1", "k2", "copies", "text").mapInArrow(
        run, "anchor long, block long, k1 long, k2 long, address long, copies long")


def lookups(texts: DataFrame, width: int) -> DataFrame:
    """(k1, k2, pos, source, listed, open): per text the anchors that occur elsewhere, in order, written.

    ``source`` is the address of another occurrence of the whole block, null where there is none
    (``open`` is true: a factor boundary); ``listed`` says that the anchor's windows stand for its block
    in the window index."""
    index = materialize(block_index(texts, width), "block_index")
    repeated = materialize(index.groupBy("anchor").agg(
        F.sum("copies").alias("n"), F.count(F.lit(1)).alias("rows"), (F.min("block") != F.max("block")).alias("varied"))
        .filter("n > 1"), "repeated_anchors")
    known = materialize(join_counted(index, repeated.select("anchor", "rows", "varied"), ["anchor"], "rows").drop("rows"), "known_blocks")
    blocks = materialize(known.groupBy("anchor", "block").agg(
        F.sum("copies").alias("n"), F.count(F.lit(1)).alias("rows"), F.min("address").alias("low"), F.max("address").alias("high")), "blocks")
    found = join_counted(known, blocks, ["anchor", "block"], "rows")
    only = F.col("n") == 1
    entry = F.struct(F.col("address").bitwiseAND((1 << _POS_BITS) - 1).alias("pos"),
                     F.when(~only, F.when(F.col("low") != F.col("address"), F.col("low")).otherwise(F.col("high"))).alias("source"),
                     (F.col("varied") & (only | (F.col("low") == F.col("address")))).alias("listed"), only.alias("open"))
    out = materialize(found.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(entry)).alias("a"))
                      .select("k1", "k2", *[F.col(f"a.{c}").alias(c) for c in ("pos", "source", "listed", "open")]), "lookups")
    discard(index, repeated, known, blocks)
    return out


def boundary_windows(texts: DataFrame, found: DataFrame, width: int) -> DataFrame:
    """(k1, k2, starts): per text the windows at factor boundaries that occur elsewhere, written."""
    reach = width - anchor_words(width)

    def run(batches) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(space_words(), lower=False)
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                _, _, data, offs = next(text_chunks(one.column("text")))
                h = hasher.hashes(data, *hasher.bounds(data, offs)[:2])
                pos, listed, open_ = (np.asarray(one.column(c).flatten()) for c in ("pos", "listed", "open"))

                def around(p):
                    lo, hi = np.maximum(p - reach, 0), np.minimum(p, len(h) - width) + 1
                    step = np.zeros(len(h) + 2, dtype=np.int32)
                    np.add.at(step, lo, 1)
                    np.add.at(step, hi, -1)
                    return np.cumsum(step)[:len(h)] > 0

                starts = np.flatnonzero(around(pos[listed]))
                a, b = window_hashes(h, starts, width)
                k = np.ones(len(starts), dtype=np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(k * one.column("k1")[0].as_py()),
                    pa.array(k * one.column("k2")[0].as_py()), pa.array(starts), pa.array(around(pos[open_])[starts])],
                    names=["a", "b", "k1", "k2", "start", "open"])

    listed = found.filter(F.exists("listed", lambda x: x))
    windows = materialize(texts.select("k1", "k2", "text").join(listed.select("k1", "k2", "pos", "listed", "open"), ["k1", "k2"])
                          .select("k1", "k2", "text", "pos", "listed", "open")
                          .mapInArrow(run, "a long, b long, k1 long, k2 long, start long, open boolean"), "windows")
    counted = materialize(windows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("rows"), F.max("open").alias("any"))
                          .filter("rows > 1 AND any").drop("any"), "repeated_windows")
    out = materialize(join_counted(windows.filter("open"), counted, ["a", "b"], "rows")
                      .groupBy("k1", "k2").agg(F.sort_array(F.collect_list("start")).alias("starts")), "boundary_windows")
    discard(windows, counted)
    return out


def _remove(width: int):
    reach = width - anchor_words(width)

    def one(text: bytes, copies: int, pos, source, open_starts, starts, ends):
        n = len(starts)
        factors = parse(n, pos, source, width)
        if copies > 1:
            first, end = (np.array([0]), np.array([n])) if n >= width else (np.zeros(0, int), np.zeros(0, int))
        else:
            first, end = merge_ranges(
                np.concatenate((np.array([f[0] for f in factors], dtype=np.int64), open_starts)),
                np.concatenate((np.array([f[0] + f[1] for f in factors], dtype=np.int64), open_starts + width)))
        return n, int((end - first).sum()), kept_words(text, starts, ends, first, end), list(zip(first.tolist(), end.tolist())), factors

    def run(batches) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(space_words(), lower=False)
        none = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for lo, hi, data, offs in text_chunks(batch.column("text")):
                starts, ends, first = hasher.bounds(data, offs)
                rows, part = [], batch.slice(lo, hi - lo)
                raw = data.tobytes()
                columns = [part.column(c).to_pylist() for c in ("k1", "k2", "copies", "doc_id", "pos", "source", "starts")]
                for i, (k1, k2, copies, doc_id, pos, source, more) in enumerate(zip(*columns)):
                    pairs = [(p, s) for p, s in zip(pos or (), source or ()) if s is not None]
                    p, s = np.array(pairs, dtype=np.int64).reshape(-1, 2).T
                    at = slice(first[i], first[i + 1])
                    rows.append((k1, k2, copies, doc_id, *one(
                        raw[offs[i]:offs[i + 1]], copies, p, s, none if more is None else np.array(more, dtype=np.int64),
                        starts[at] - offs[i], ends[at] - offs[i])))
                cols = list(zip(*rows))
                pairs_type = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
                factor_type = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "source", "source_start")]))
                yield pa.RecordBatch.from_arrays([
                    *[pa.array(c, pa.int64()) for c in cols[:6]], pa.array(cols[6], pa.string()),
                    pa.array([[{"first": a, "end": b} for a, b in v] for v in cols[7]], pairs_type),
                    pa.array([[dict(zip(("start", "length", "source", "source_start"), f)) for f in v] for v in cols[8]], factor_type),
                ], names=["k1", "k2", "copies", "doc_id", "n_words", "n_removed", "kept_text", "removed", "factors"])
    return run


def _copies(width: int):
    """What copies of one text keep: nothing, or all of a text shorter than a window."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(space_words(), lower=False)
        for batch in batches:
            for lo, hi, data, offs in text_chunks(batch.column("text")):
                starts, ends, first = hasher.bounds(data, offs)
                n = np.diff(first)
                raw, part = data.tobytes(), batch.slice(lo, hi - lo)
                kept = [b" ".join(raw[offs[i]:offs[i + 1]].split()) if n[i] < width else b"" for i in range(len(n))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("k1"), part.column("k2"), pa.array(n),
                                                  pa.array(kept, pa.string())], names=["doc_id", "k1", "k2", "n_words", "kept_text"])
    return run


def parse_texts(texts: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per text of ``distinct_texts``: (k1, k2, copies, doc_id, n_words, n_removed, kept_text, removed, factors).

    ``removed`` are the word ranges covered by repeated windows; ``factors`` the copied stretches of the
    parse, each with a code of its source text and the place in it."""
    if width < 2:
        raise ValueError("width must be at least 2")
    found = lookups(texts, width)
    more = boundary_windows(texts, found, width)
    plan = materialize(found.select("k1", "k2", "pos", "source").join(more, ["k1", "k2"], "left"), "parse_plan")
    return texts.join(plan, ["k1", "k2"], "left").select("k1", "k2", "copies", "doc_id", "text", "pos", "source", "starts") \
        .mapInArrow(_remove(width), "k1 long, k2 long, copies long, doc_id long, n_words long, n_removed long, "
                                    f"kept_text string, removed array<{RANGE}>, factors array<{FACTOR}>")


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text, removed) of every row of ``docs`` (doc_id, text)."""
    texts = distinct_texts(docs)
    alone = parse_texts(texts, width).filter("copies = 1").select("doc_id", "n_words", "n_removed", "kept_text", "removed")
    rows = materialize(_keyed(docs).select("doc_id", "k1", "k2", "text").mapInArrow(
        _copies(width), "doc_id long, k1 long, k2 long, n_words long, kept_text string"), "rows")
    copied = join_counted(rows, texts.filter("copies > 1").select("k1", "k2", "copies"), ["k1", "k2"], "copies")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("first"), F.col("n_words").alias("end")))
    gone = F.col("n_words") >= width
    return alone.unionByName(copied.select(
        "doc_id", "n_words", F.when(gone, F.col("n_words")).otherwise(F.lit(0).cast("long")).alias("n_removed"), "kept_text",
        F.when(gone, whole).otherwise(F.array().cast(f"array<{RANGE}>")).alias("removed")))
