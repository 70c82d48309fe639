"""Fill-in-the-middle by in-place block rotation.

A text is scanned for the byte offsets of its two cuts and copied into a bytearray, sentinels are
inserted before prefix, middle and suffix, and the segments change places by rotations of
neighbouring blocks, each done as three reversals inside the bytearray:

    <P>prefix <M>middle <S>suffix      as inserted
    <P>prefix <S>suffix <M>middle      psm: the last two blocks rotated
    <S>suffix <P>prefix <M>middle      spm: then the first two

The restoration finds the sentinels, runs the inverse rotations and deletes the sentinels.  A
reversal swaps blocks of ``BLOCK`` bytes from both ends, so the scratch space does not depend on
the text.  One text is worked on at a time and rows leave in frames of bounded size; nothing is
shuffled, so no group can be hot.

Form and cuts follow from the seed and doc_id alone (SHA-256), so reruns agree.  Cuts fall
between code points.

Defined results: a null text counts as empty, and an empty text is plain; a text that holds a
sentinel is plain (it could not be taken apart again); a null doc_id is hashed as no digits;
rows with one doc_id draw the same numbers, each for its own length; equal rows give equal
rows; an empty table gives an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.llm.common import read_columns

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = 1
#: of 100: texts from this remainder on stay plain
PLAIN_FROM = 90
#: of 100: transformed texts below this remainder put the suffix first
SPM_BELOW = 20
BLOCK = 1 << 16
#: a frame of results is closed at this many bytes of text or rows
FRAME_BYTES, FRAME_ROWS = 4 << 20, 2048
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


# --- one text --------------------------------------------------------------------------------
def _leads(data: np.ndarray) -> np.ndarray:
    """True at the first byte of every code point."""
    return (data & 0xC0) != 0x80


def count_points(data: np.ndarray) -> int:
    return sum(int(np.count_nonzero(_leads(data[lo:lo + BLOCK]))) for lo in range(0, len(data), BLOCK))


def scan_cuts(data: np.ndarray, cuts: tuple[int, int]) -> list[int]:
    """Byte offsets before the code points numbered ``cuts`` (ascending), found in one scan."""
    out, seen, lo = [], 0, 0
    while len(out) < len(cuts) and lo < len(data):
        leads = np.flatnonzero(_leads(data[lo:lo + BLOCK]))
        while len(out) < len(cuts) and cuts[len(out)] < seen + len(leads):
            out.append(lo + int(leads[cuts[len(out)] - seen]))
        seen += len(leads)
        lo += BLOCK
    return out + [len(data)] * (len(cuts) - len(out))


def reverse(view: np.ndarray, lo: int, hi: int) -> None:
    """Reverses ``view[lo:hi]`` in place."""
    while hi - lo > 1:
        k = min((hi - lo) // 2, BLOCK)
        kept = view[lo:lo + k].copy()
        view[lo:lo + k] = view[hi - k:hi][::-1]
        view[hi - k:hi] = kept[::-1]
        lo, hi = lo + k, hi - k


def rotate(view: np.ndarray, lo: int, mid: int, hi: int) -> None:
    """Exchanges the neighbouring blocks ``[lo, mid)`` and ``[mid, hi)`` by three reversals."""
    reverse(view, lo, mid)
    reverse(view, mid, hi)
    reverse(view, lo, hi)


def transform(text: bytes, prefix: int, middle: int, form: str) -> bytearray:
    """``text`` with its blocks in the order of ``form``; ``prefix`` and ``middle`` are the byte
    offsets at which these blocks end."""
    buf = bytearray(text)
    if form == "plain":
        return buf
    for at, mark in ((middle, SUFFIX), (prefix, MIDDLE), (0, PREFIX)):
        buf[at:at] = mark
    end, m, s = len(buf), prefix + len(PREFIX), middle + len(PREFIX) + len(MIDDLE)
    view = np.frombuffer(buf, dtype=np.uint8)
    rotate(view, m, s, end)
    if form == "spm":
        rotate(view, 0, m, m + end - s)
    return buf


def restore(output: bytes, form: str) -> bytearray:
    """The text that ``transform`` was given."""
    buf = bytearray(output)
    if form == "plain":
        return buf
    end = len(buf)
    if form == "spm":
        p = buf.find(PREFIX, len(SUFFIX))
        m = buf.find(MIDDLE, p + len(PREFIX))
        rotate(np.frombuffer(buf, dtype=np.uint8), 0, p, m)
        s = m - p
    else:
        s = buf.find(SUFFIX, len(PREFIX))
        m = buf.find(MIDDLE, s + len(SUFFIX))
    rotate(np.frombuffer(buf, dtype=np.uint8), s, m, end)
    for at, mark in ((s + end - m, SUFFIX), (s, MIDDLE), (0, PREFIX)):
        del buf[at:at + len(mark)]
    return buf


def draw(seed: int, doc_id: int | None) -> list[int]:
    """The first four 8-digit groups of the hexadecimal SHA-256 of ``seed:doc_id``."""
    text = f"{seed}:{'' if doc_id is None else doc_id}"
    return np.frombuffer(hashlib.sha256(text.encode()).digest()[:16], dtype=">u4").tolist()


# --- tables ----------------------------------------------------------------------------------
def _frames(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], text_at: int) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[text_at])
        if size >= FRAME_BYTES or len(held) >= FRAME_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)


def transform_documents(docs: DataFrame, seed: int = SEED, plain_from: int = PLAIN_FROM,
                        spm_below: int = SPM_BELOW) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row of ``docs`` (doc_id, text).

    ``n``, ``prefix_chars`` and ``middle_chars`` count code points; the last two are null where the
    text stays plain."""
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def one(doc_id, text: bytes) -> tuple:
        data = np.frombuffer(text, dtype=np.uint8)
        n = count_points(data)
        h1, h2, h3, h4 = draw(seed, doc_id)
        if n == 0 or h3 % 100 >= plain_from or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
            return doc_id, n, "plain", None, None, text
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        form = "spm" if h4 % 100 < spm_below else "psm"
        return doc_id, n, form, a, b - a, bytes(transform(text, *scan_cuts(data, (a, b)), form))

    def run(batches):
        def rows():
            for batch in batches:
                texts = batch.column("text").cast(pa.large_binary())
                for doc_id, text in zip(batch.column("doc_id"), texts):
                    yield one(doc_id.as_py(), text.as_py() or b"")
        yield from _frames(rows(), names, types, 5)

    return read_columns(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)


def restore_documents(transformed: DataFrame) -> DataFrame:
    """The rows of ``transform_documents`` with ``restored``, rebuilt from output and form alone."""
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def run(batches):
        def rows():
            for batch in batches:
                columns = [batch.column(c) for c in names[:5]]
                for *kept, output in zip(*columns, batch.column("output").cast(pa.large_binary())):
                    kept, output = [v.as_py() for v in kept], output.as_py()
                    yield (*kept, output, bytes(restore(output, kept[2])))
        yield from _frames(rows(), names, types, 5)

    return transformed.mapInArrow(run, SCHEMA + ", restored string")
