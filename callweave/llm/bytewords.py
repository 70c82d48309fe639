"""Word boundaries and 64-bit word hashes over UTF-8 buffers, vectorised with numpy.

Arrow string columns keep all texts of a batch in one UTF-8 buffer.  The word classes of
the operators only name ASCII characters as separators, and every byte of a multi-byte
character is >= 0x80, so words can be cut on bytes.  Texts are handled in chunks of
bounded size (a text is never split between chunks), so memory does not depend on the
batch size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
_HASH_BYTES = 1 << 20

_MULT = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _splitmix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser (public domain constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


mix64 = _splitmix


def space_words() -> np.ndarray:
    """Byte class of ``[^\\x20\\x09-\\x0D]``."""
    lut = np.ones(256, dtype=bool)
    lut[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
    return lut


def alnum_words() -> np.ndarray:
    """Byte class of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z is lower-cased."""
    lut = np.zeros(256, dtype=bool)
    for a, b in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
        lut[a:b + 1] = True
    return lut


def byte_table(lower: bool) -> np.ndarray:
    """Random 64-bit value per byte; A-Z share the value of a-z when ``lower``."""
    t = _splitmix(np.arange(1, 257, dtype=np.uint64) * _MULT)
    if lower:
        t[0x41:0x5B] = t[0x61:0x7B]
    return t


class WordHasher:
    """Cuts chunks into words and hashes them (polynomial in an odd multiplier, then mixed)."""

    def __init__(self, is_word: np.ndarray, lower: bool = True):
        self.is_word = is_word
        self.table = byte_table(lower)
        self._pow = np.ones(1, dtype=np.uint64)
        self._inv = np.ones(1, dtype=np.uint64)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._pow) < n:
            with np.errstate(over="ignore"):
                steps = np.full(n, _MULT)
                steps[0] = 1
                self._pow = np.cumprod(steps)
                steps[1:] = _INV
                self._inv = np.cumprod(steps)
        return self._pow, self._inv

    def bounds(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, first): word byte ranges and, per text, the index of its first word."""
        w = self.is_word[data]
        n = len(data)
        if n == 0:
            z = np.zeros(0, dtype=np.int64)
            return z, z, np.zeros(len(offs), dtype=np.int64)
        st = w.copy()
        st[1:] &= ~w[:-1]
        en = w.copy()
        en[:-1] &= ~w[1:]
        inner = offs[1:-1]
        inner = inner[(inner > 0) & (inner < n)]
        st[inner] = w[inner]
        en[inner - 1] = w[inner - 1]
        starts = np.flatnonzero(st)
        ends = np.flatnonzero(en) + 1
        return starts, ends, np.searchsorted(starts, offs).astype(np.int64)

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), dtype=np.uint64)
        i = 0
        while i < len(starts):
            lo = int(starts[i])
            j = max(i + 1, int(np.searchsorted(ends, lo + _HASH_BYTES, side="right")))
            hi = int(ends[j - 1])
            pw, inv = self._powers(hi - lo + 1)
            v = self.table[data[lo:hi]]
            v *= pw[:hi - lo]
            c = np.empty(hi - lo + 1, dtype=np.uint64)
            c[0] = 0
            np.cumsum(v, out=c[1:])
            s, e = starts[i:j] - lo, ends[i:j] - lo
            out[i:j] = (c[e] - c[s]) * inv[s] + (e - s).astype(np.uint64)
            i = j
        return _splitmix(out)


def text_chunks(col: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES
                ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, byte offsets) of runs of texts up to ``limit`` bytes.

    Null texts have no bytes.  A text longer than ``limit`` forms its own chunk."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    n = len(col)
    if n == 0:
        return
    _, ob, db = col.buffers()
    offs = np.frombuffer(ob, dtype=np.int64)[col.offset:col.offset + n + 1]
    data = np.frombuffer(db, dtype=np.uint8) if db is not None else np.zeros(0, dtype=np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi
