"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` cuts the corpus into segments (a few MB of text each).  A segment is one
row: the ids and token counts of its documents, its sorted distinct term hashes, and the
delta-coded token positions of every term.  Building needs no shuffle and the index can be
kept and searched again for another benchmark.

``search_phrases`` ships the test windows (in blocks of bounded size) to the segments.  In
each segment the posting lists of a window are intersected, shifted by their offset in the
window, beginning with the two rarest terms of the window in that segment.
``search_near`` returns the places around which a document holds all terms of a phrase within some words;
``search_spans`` the documents in which a run of words, at most so many times as long as the item, has them all.

Words: A-Z lower-cased, `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`, compared by 64-bit hash.
Defined results: null or empty texts have no words, are never hit and stay in the result;
an item without words is no window; an item shorter than the window is one window;
repeated rows, repeated or null ids each keep their own result row.  Items without id are
searched like others; in a document's items all of them are one null, ordered last.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callweave.llm.bytewords import WordHasher, alnum_words, text_chunks
from callweave.llm.common import free_name, materialize, read_columns

WINDOW = 13
#: a run of words is near an item if it holds the item's words and is at most so many times as long
STRETCH = 2
#: documents in a segment are taken until their texts reach this size
SEGMENT_BYTES = 3 << 20
#: test tokens that are shipped to the segments at once (8 bytes each)
BLOCK_TOKENS = 2_000_000

INDEX_SCHEMA = ("segment long, doc_ids array<bigint>, n_words array<int>, terms binary, term_starts binary, "
                "postings binary")
MATCH_SCHEMA = "segment long, ord int, item_id string, first int, last int"


# --- index ---------------------------------------------------------------------------------
def _segments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext
    part = TaskContext.get().partitionId() << 32
    hasher = WordHasher(alnum_words(), lower=True)
    made = 0
    for batch in batches:
        ids = batch.column("doc_id")
        for lo, hi, data, offs in text_chunks(batch.column("text"), SEGMENT_BYTES):
            starts, ends, first = hasher.bounds(data, offs)
            h = hasher.hashes(data, starts, ends)
            order = np.argsort(h, kind="stable").astype(np.int32)
            hs = h[order]
            new = np.ones(len(hs), dtype=bool)
            new[1:] = hs[1:] != hs[:-1]
            at = np.flatnonzero(new).astype(np.int32)
            delta = order.copy()
            delta[1:] -= order[:-1]
            delta[at] = order[at]
            yield pa.RecordBatch.from_arrays([
                pa.array([part + made], pa.int64()),
                pa.array([ids.slice(lo, hi - lo).cast(pa.int64()).to_pylist()], pa.list_(pa.int64())),
                pa.array([np.diff(first).astype(np.int32)], pa.list_(pa.int32())),
                pa.array([hs[at].tobytes()], pa.binary()),
                pa.array([at.tobytes()], pa.binary()),
                pa.array([delta.tobytes()], pa.binary()),
            ], names=["segment", "doc_ids", "n_words", "terms", "term_starts", "postings"])
            made += 1


def build_index(docs: DataFrame) -> DataFrame:
    """Positional index of ``docs`` (doc_id, text), written once and read back."""
    src = read_columns(docs, "doc_id", "text")
    index = src.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(_segments, INDEX_SCHEMA)
    return materialize(index, "positional_index")


def documents_of(index: DataFrame) -> DataFrame:
    """(segment, ord, doc_id, n_words): the indexed documents."""
    return index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("ord", "d")) \
        .select("segment", "ord", F.col("d.doc_ids").alias("doc_id"), F.col("d.n_words").alias("n_words"))


class Segment:
    """Posting lists of one segment row, addressed by (term rank, position) keys."""

    def __init__(self, row: dict):
        self.id = row["segment"]
        self.n_words = np.asarray(row["n_words"], dtype=np.int64)
        self.doc_start = np.concatenate(([0], np.cumsum(self.n_words)))
        self.terms = np.frombuffer(row["terms"], dtype=np.uint64)
        at = np.frombuffer(row["term_starts"], dtype=np.int32)
        delta = np.frombuffer(row["postings"], dtype=np.int32).astype(np.int64)
        self.starts = np.append(at, len(delta)).astype(np.int64)
        self.counts = np.diff(self.starts)
        run = np.cumsum(delta)
        base = np.where(at > 0, run[np.maximum(at, 1) - 1], 0) if len(at) else np.zeros(0, dtype=np.int64)
        self.pos = run - np.repeat(base, self.counts)
        self.key = (np.repeat(np.arange(len(at), dtype=np.int64), self.counts) << 32) | self.pos

    def ranks(self, vocab: np.ndarray) -> np.ndarray:
        """Rank of each term in this segment, -1 where it doesn't occur."""
        if not len(self.terms):
            return np.full(len(vocab), -1, dtype=np.int64)
        i = np.minimum(np.searchsorted(self.terms, vocab), len(self.terms) - 1)
        return np.where(self.terms[i] == vocab, i, -1)

    def holds(self, rank: np.ndarray, pos: np.ndarray) -> np.ndarray:
        k = (rank << 32) | pos
        i = np.minimum(np.searchsorted(self.key, k), len(self.key) - 1)
        return (pos >= 0) & (self.key[i] == k)

    def postings(self, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which, position): all positions of each term in ``rank``."""
        c = self.counts[rank]
        which = np.repeat(np.arange(len(rank)), c)
        inner = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
        return which, self.pos[self.starts[rank][which] + inner]

    def doc_of(self, pos: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.doc_start, pos, side="right") - 1


class Phrases:
    """Test windows of one block: distinct windows as vocabulary indices plus their items."""

    def __init__(self, items: list[tuple[str | None, np.ndarray]], window: int):
        seen: dict[bytes, int] = {}
        rows: list[np.ndarray] = []
        win_ids: list[int] = []
        item_ids: list[int] = []
        self.items = [i for i, _ in items]
        for k, (_, h) in enumerate(items):
            m = min(window, len(h))
            for i in range(len(h) - m + 1 if m else 0):
                w = h[i:i + m]
                n = seen.setdefault(w.tobytes(), len(rows))
                if n == len(rows):
                    rows.append(w)
                win_ids.append(n)
                item_ids.append(k)
        self.length = np.array([len(r) for r in rows], dtype=np.int64)
        flat = np.concatenate(rows) if rows else np.zeros(0, dtype=np.uint64)
        self.vocab, inv = np.unique(flat, return_inverse=True)
        self.matrix = np.full((len(rows), window), -1, dtype=np.int64)
        self.matrix[np.arange(window)[None, :] < self.length[:, None]] = inv
        pairs = np.unique(np.array([win_ids, item_ids], dtype=np.int64).T.reshape(-1, 2), axis=0)
        self.win_item = pairs[:, 1]
        self.win_start = np.searchsorted(pairs[:, 0], np.arange(len(rows) + 1))


def phrase_matches(seg: Segment, ph: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(window, position) of every exact occurrence inside one document."""
    none = np.zeros(0, dtype=np.int64)
    if not len(ph.length) or not len(seg.terms):
        return none, none
    rank = seg.ranks(ph.vocab)
    m = np.where(ph.matrix >= 0, rank[ph.matrix], -2)  # -2: past the window's end
    win = np.flatnonzero(~(m == -1).any(axis=1))
    if not len(win):
        return none, none
    m = m[win]
    count = np.where(m >= 0, seg.counts[m], np.iinfo(np.int64).max)
    by_rarity = np.argsort(count, axis=1, kind="stable")
    lead = by_rarity[:, 0]
    which, pos = seg.postings(m[np.arange(len(win)), lead])
    pos = pos - lead[which]
    for k in range(1, m.shape[1]):
        off = by_rarity[which, k]
        r = m[which, off]
        ok = (r < 0) | seg.holds(np.maximum(r, 0), pos + off)
        ok &= pos >= 0
        which, pos = which[ok], pos[ok]
        if not len(pos):
            return none, none
    keep = pos >= 0
    which, pos = which[keep], pos[keep]
    d = seg.doc_of(pos)
    inside = pos + ph.length[win[which]] <= seg.doc_start[d + 1]
    return win[which][inside], pos[inside]


def _merged(seg: Segment, ph: Phrases, win: np.ndarray, pos: np.ndarray) -> pa.RecordBatch | None:
    """Occurrences as runs per (document, item): first and last hit word, counted in the document."""
    if not len(win):
        return None
    n = ph.win_start[win + 1] - ph.win_start[win]
    occ = np.repeat(np.arange(len(win)), n)
    item = ph.win_item[np.repeat(ph.win_start[win] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    doc = seg.doc_of(pos)[occ]
    lo = pos[occ] - seg.doc_start[doc]
    hi = lo + ph.length[win][occ] - 1
    o = np.lexsort((hi, lo, item, doc))
    doc, item, lo, hi = doc[o], item[o], lo[o], hi[o]
    group = np.ones(len(o), dtype=bool)
    group[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])
    # running maximum of hi inside a group: lift each group above the former
    g = np.cumsum(group) - 1
    span = int(hi.max()) + 2
    top = np.maximum.accumulate(hi + g * span)
    new = group.copy()
    new[1:] |= lo[1:] + g[1:] * span > top[:-1] + 1
    at = np.flatnonzero(new)
    end = np.append(at[1:], len(o)) - 1
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(len(at), seg.id), pa.int64()), pa.array(doc[at], pa.int32()),
        pa.array([ph.items[i] for i in item[at]], pa.string()), pa.array(lo[at], pa.int32()),
        pa.array(top[end] - g[end] * span, pa.int32()),
    ], names=["segment", "ord", "item_id", "first", "last"])


def _item_hashes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = WordHasher(alnum_words(), lower=True)
    for batch in batches:
        for lo, hi, data, offs in text_chunks(batch.column("text")):
            starts, ends, first = hasher.bounds(data, offs)
            h = hasher.hashes(data, starts, ends)
            yield pa.RecordBatch.from_arrays([
                batch.column("item_id").slice(lo, hi - lo),
                pa.array([h[first[i]:first[i + 1]].tobytes() for i in range(hi - lo)], pa.binary()),
                pa.array(np.diff(first), pa.int64()),
            ], names=["item_id", "h", "n"])


def test_blocks(items: DataFrame, block_tokens: int = BLOCK_TOKENS) -> Iterator[list[tuple[str | None, np.ndarray]]]:
    """Items with words, in blocks of about ``block_tokens`` tokens (an item is never split)."""
    src = read_columns(items, "item_id", "text")
    hashed = src.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(_item_hashes, "item_id string, h binary, n long").filter("n > 0")
    hashed = materialize(hashed.distinct(), "test_items")
    total = hashed.agg(F.sum("n")).first()[0] or 0
    blocks = -(-total // block_tokens)
    for b in range(blocks):
        rows = hashed.filter(F.pmod(F.xxhash64("item_id", "h"), F.lit(blocks)) == b).collect() if blocks > 1 \
            else hashed.collect()
        if rows:
            yield [(r["item_id"], np.frombuffer(r["h"], dtype=np.uint64)) for r in sorted(rows, key=lambda r: (r["item_id"] is None, r["item_id"] or "", r["h"]))]


def search_phrases(index: DataFrame, items: DataFrame, window: int = WINDOW,
                   block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(segment, ord, item_id, first, last): runs of words inside occurrences of an item's windows."""
    spark = index.sparkSession
    out = spark.createDataFrame([], MATCH_SCHEMA)
    for block in test_blocks(items, block_tokens):
        shared = spark.sparkContext.broadcast(block)

        def search(batches, shared=shared):
            ph = Phrases(shared.value, window)
            for batch in batches:
                for row in batch.to_pylist():
                    seg = Segment(row)
                    found = _merged(seg, ph, *phrase_matches(seg, ph))
                    if found is not None:
                        yield found

        out = out.unionByName(_segment_rows(index).mapInArrow(search, MATCH_SCHEMA))
    return out


def _segment_rows(index: DataFrame) -> DataFrame:
    return index.select("segment", "n_words", "terms", "term_starts", "postings")


def near_places(seg: Segment, rank: np.ndarray, within: int) -> np.ndarray:
    """Positions of the rarest of some terms around which all of them occur, at most ``within`` words away."""
    rank = rank[np.argsort(seg.counts[rank], kind="stable")]
    _, pos = seg.postings(rank[:1])
    doc = seg.doc_of(pos)
    lo = np.maximum(pos - within, seg.doc_start[doc])
    hi = np.minimum(pos + within, seg.doc_start[doc + 1] - 1)
    for r in rank[1:]:
        p = seg.pos[seg.starts[r]:seg.starts[r + 1]]
        ok = np.searchsorted(p, hi, side="right") > np.searchsorted(p, lo)
        pos, lo, hi = pos[ok], lo[ok], hi[ok]
        if not len(pos):
            break
    return pos


def has_span(seg: Segment, rank: np.ndarray, lo: int, hi: int, span: int) -> bool:
    """Whether some ``span`` consecutive words between the positions ``lo`` and ``hi`` (exclusive) hold all terms.

    An occurrence serves the runs that end on it or later, up to ``span`` - 1 words on or the term's next
    occurrence, so the terms that a run holds are a running sum; time is linear in the words looked at."""
    change = np.zeros(hi - lo + 1, dtype=np.int64)
    for r in rank:
        p = seg.pos[seg.starts[r]:seg.starts[r + 1]]
        p = p[np.searchsorted(p, lo):np.searchsorted(p, hi)] - lo
        if not len(p):
            return False
        change[p] += 1
        change[np.minimum(np.append(p[1:], hi - lo), np.minimum(p + span, hi - lo))] -= 1
    return bool((np.cumsum(change[:-1]) == len(rank)).any())


class ItemTerms:
    """The distinct terms of one block's items over a shared vocabulary."""

    def __init__(self, items: list[tuple[str | None, np.ndarray]]):
        self.items = [i for i, _ in items]
        self.n_words = [len(h) for _, h in items]
        terms = [np.unique(h) for _, h in items]
        self.vocab, self.flat = np.unique(np.concatenate(terms), return_inverse=True)
        self.at = np.concatenate(([0], np.cumsum([len(t) for t in terms])))


def span_documents(seg: Segment, terms: ItemTerms, stretch: int) -> Iterator[tuple[str | None, np.ndarray]]:
    """(item, documents): where a run of at most ``stretch`` times the item's words holds all its terms."""
    rank = seg.ranks(terms.vocab)[terms.flat]
    for k in np.flatnonzero(np.minimum.reduceat(rank, terms.at[:-1]) >= 0):
        mine, span = rank[terms.at[k]:terms.at[k + 1]], stretch * terms.n_words[k]
        pos = near_places(seg, mine, span - 1)
        if not len(pos):
            continue
        doc, first = np.unique(seg.doc_of(pos), return_index=True)
        if len(mine) > 1:
            last = np.append(first[1:], len(pos)) - 1
            lo = np.maximum(pos[first] - span + 1, seg.doc_start[doc])
            hi = np.minimum(pos[last] + span, seg.doc_start[doc + 1])
            doc = doc[[has_span(seg, mine, int(a), int(b), span) for a, b in zip(lo, hi)]]
        if len(doc):
            yield terms.items[k], doc


def search_spans(index: DataFrame, items: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """(segment, ord, item_id): documents in which some run of consecutive words, at most ``stretch`` times as long
    as the item, holds every distinct word of the item, in any order; one row per document and item text."""
    if stretch < 1:
        raise ValueError(f"a run is at least as long as its item, not {stretch} times")
    spark = index.sparkSession
    schema = "segment long, ord int, item_id string"
    out = spark.createDataFrame([], schema)
    for block in test_blocks(items):
        shared = spark.sparkContext.broadcast(block)

        def search(batches, shared=shared):
            terms = ItemTerms(shared.value)
            for batch in batches:
                for row in batch.to_pylist():
                    seg = Segment(row)
                    if not len(seg.terms):
                        continue
                    for item, doc in span_documents(seg, terms, stretch):
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.full(len(doc), seg.id), pa.int64()), pa.array(doc, pa.int32()),
                            pa.array([item] * len(doc), pa.string())], names=["segment", "ord", "item_id"])

        out = out.unionByName(_segment_rows(index).mapInArrow(search, schema))
    return out


def search_near(index: DataFrame, items: DataFrame, within: int) -> DataFrame:
    """(segment, ord, item_id, first): places of an item's rarest term around which all the item's
    distinct terms occur at most ``within`` words away, in the same document."""
    spark = index.sparkSession
    schema = "segment long, ord int, item_id string, first int"
    out = spark.createDataFrame([], schema)
    for block in test_blocks(items):
        shared = spark.sparkContext.broadcast(block)

        def search(batches, shared=shared):
            for batch in batches:
                for row in batch.to_pylist():
                    seg = Segment(row)
                    for item, h in shared.value:
                        rank = seg.ranks(np.unique(h))
                        if (rank < 0).any():
                            continue
                        pos = near_places(seg, rank, within)
                        if len(pos):
                            doc = seg.doc_of(pos)
                            yield pa.RecordBatch.from_arrays([
                                pa.array(np.full(len(pos), seg.id), pa.int64()), pa.array(doc, pa.int32()),
                                pa.array([item] * len(pos), pa.string()),
                                pa.array(pos - seg.doc_start[doc], pa.int32()),
                            ], names=["segment", "ord", "item_id", "first"])

        out = out.unionByName(_segment_rows(index).mapInArrow(search, schema))
    return out


# --- digest ----------------------------------------------------------------------------------
def hit_counts(matches: DataFrame) -> DataFrame:
    """(segment, ord, n_hit, items): words in any run, and the items, of each document hit."""
    w = Window.partitionBy("segment", "ord").orderBy("first", "last")
    before = F.max("last").over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("last") + 1 - F.greatest(F.col("first"), F.coalesce(before + 1, F.lit(0))))
    return matches.withColumn("fresh", fresh).groupBy("segment", "ord") \
        .agg(F.sum("fresh").cast("long").alias("n_hit"), F.collect_set(F.struct("item_id"))["item_id"].alias("items"))  # keeps null


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, percent: int = 5,
                  stretch: int | None = None) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, items (sorted array of strings, null last), contaminated.

    Contaminated: some word is hit and hit words are at least ``percent`` % of all words.  With ``stretch``
    also n_near, the number of items (those without id count as one) that ``search_spans`` finds in the document."""
    index = build_index(docs)
    hits = hit_counts(search_phrases(index, items, window))
    more = []
    if stretch is not None:
        near = search_spans(index, items, stretch).distinct().groupBy("segment", "ord").agg(F.count(F.lit(1)).alias("n_near"))
        hits = hits.join(near, ["segment", "ord"], "full")
        more = [F.coalesce("n_near", F.lit(0)).alias("n_near")]
    none = F.array().cast("array<string>")
    return documents_of(index).join(hits, ["segment", "ord"], "left").select(
        "doc_id", *more, F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.array_sort(F.coalesce("items", none)).alias("items")) \
        .withColumn("contaminated", (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= percent * F.col("n_words")))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, percent: int = 5) -> DataFrame:
    """``docs`` without the contaminated rows; all columns are kept.

    A row is told apart by its id and text, so rows that share an id are judged one by one."""
    id_, name = F.col("doc_id").cast("long"), free_name(docs, "_row")
    row = F.xxhash64(id_.isNull(), id_, F.col("text").isNull(), "text")
    bad = contamination(docs.select(row.alias("doc_id"), "text"), items, window, percent) \
        .filter("contaminated").select(F.col("doc_id").alias(name)).distinct()
    return docs.withColumn(name, row).join(bad, name, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
