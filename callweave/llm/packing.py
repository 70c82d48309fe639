"""Token ids packed into fixed-length sequences by best-fit decreasing.

Documents are tokenised where they are read and buffered into blocks of bounded size; each
block is packed by itself, so nothing is shuffled.  Documents longer than a sequence are split
into pieces without loss.  Pieces are placed longest first into the open sequence with the
least room that still holds them; that sequence is found by a segment tree over room sizes.

A packed row is one sequence: padded ids, cumulative segment lengths, and positions that
restart at every segment, plus (doc_id, piece) of each segment, from which the texts can be
put together again.  The vocabulary file is a parameter and is sent to the tasks as it is.

Defined results: a null or empty text is one segment that holds the end token alone; repeated
rows are packed each; null ids are kept as null; an empty table gives no sequence; extra
columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.llm.common import read_columns

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: pre-tokenisation of the byte-level BPE vocabulary (fixed value, published with it)
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: runs of white space (the Unicode property, as in PATTERN) from this length on are cut out before PATTERN is applied
LONG_RUN = 10_000
_LONG_SPACE = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]{%d,}" % LONG_RUN)
LENGTH = 2048
BLOCK_TOKENS = 2_000_000
SCHEMA = ("sequence long, n_tokens int, n_segments int, ids binary, cu_seqlens array<int>, position_ids binary, "
          "doc_ids array<bigint>, pieces array<int>")


class Tokens:
    """Byte-level BPE; every vocabulary id is below ``end``, the end token."""

    def __init__(self, vocabulary: bytes):
        import tiktoken
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in vocabulary.splitlines() if x)}
        self.encoding = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.end = max(ranks.values()) + 1
        self.size = self.end + 1

    def encode(self, text: str) -> list[int]:
        """The ids of the whole text.

        Its regular expression backtracks over runs of white space and runs out of stack at about a
        million.  A long run is therefore cut out by hand, where the expression cuts it, too: all of
        it is a piece if the text ends there, else all but its last character, which goes
        with what follows."""
        if len(text) <= LONG_RUN:
            return self.encoding.encode_ordinary(text)
        out, at = [], 0
        for run in _LONG_SPACE.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            out += self.encoding.encode_ordinary(text[at:run.start()])
            out += self.encoding._encode_single_piece(text[run.start():end])
            at = end
        return out + self.encoding.encode_ordinary(text[at:])

    def decode(self, ids: Iterable[int]) -> str:
        return self.encoding.decode(list(ids))


class RoomTree:
    """Segment tree over room sizes 0..capacity: the least size >= x that some sequence has."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, room: int, by: int = 1) -> None:
        i = room + self.leaves
        while i:
            self.count[i] += by
            i >>= 1

    def least(self, x: int) -> int:
        """-1 where no sequence has that much room."""
        i = x + self.leaves
        if self.count[i]:
            return x
        while i > 1:
            if not i & 1 and self.count[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.leaves
            i >>= 1
        return -1


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Indices of the pieces of each sequence; every piece is at most ``capacity`` long."""
    tree, open_, out = RoomTree(capacity), [[] for _ in range(capacity + 1)], []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        room = tree.least(n) if n < capacity else -1
        if room < 0:
            k, room = len(out), capacity
            out.append([i])
        else:
            k = open_[room].pop()
            tree.add(room, -1)
            out[k].append(i)
        if room - n > 0:
            open_[room - n].append(k)
            tree.add(room - n)
    return out


def pack_documents(docs: DataFrame, vocabulary: str = VOCABULARY, length: int = LENGTH,
                   block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Packed sequences of ``docs`` (doc_id, text); see SCHEMA.

    ``ids`` and ``position_ids`` are ``length`` little-endian unsigned numbers, of 2 bytes where
    vocabulary and length allow and else of 4; the rest of a sequence after ``n_tokens`` is padded with
    the end token and positions 0.  Every document ends with the end token."""
    if length < 1:
        raise ValueError("length must be at least 1")
    spark = docs.sparkSession
    with open(vocabulary, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())

    def pack(batches):
        from pyspark import TaskContext
        tokens = Tokens(shared.value)
        dtype = np.dtype("<u2" if max(tokens.size, length) <= 1 << 16 else "<u4")
        row = TaskContext.get().partitionId() << 32
        ids, keys, pieces, held = [], [], [], 0

        def flush():
            nonlocal row, ids, keys, pieces, held
            lengths = np.array([len(x) for x in ids], dtype=np.int64)
            plan = best_fit_decreasing(lengths, length)
            for lo in range(0, len(plan), 256):
                some = plan[lo:lo + 256]
                matrix = np.full((len(some), length), tokens.end, dtype=dtype)
                place = np.zeros((len(some), length), dtype=dtype)
                cu = []
                for r, members in enumerate(some):
                    ends = np.cumsum(lengths[members])
                    cu.append(np.concatenate(([0], ends)).astype(np.int32))
                    matrix[r, :ends[-1]] = np.concatenate([ids[i] for i in members])
                    place[r, :ends[-1]] = np.arange(ends[-1]) - np.repeat(ends - lengths[members], lengths[members])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(row, row + len(some)), pa.int64()),
                    pa.array([int(c[-1]) for c in cu], pa.int32()), pa.array([len(m) for m in some], pa.int32()),
                    pa.array([x.tobytes() for x in matrix], pa.binary()), pa.array(cu, pa.list_(pa.int32())),
                    pa.array([x.tobytes() for x in place], pa.binary()),
                    pa.array([[keys[i] for i in m] for m in some], pa.list_(pa.int64())),
                    pa.array([[pieces[i] for i in m] for m in some], pa.list_(pa.int32())),
                ], names=["sequence", "n_tokens", "n_segments", "ids", "cu_seqlens", "position_ids", "doc_ids", "pieces"])
                row += len(some)
            ids, keys, pieces, held = [], [], [], 0

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for key, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    got = np.array(tokens.encode(text or "") + [tokens.end], dtype=dtype)
                    for n, cut in enumerate(range(0, len(got), length)):
                        ids.append(got[cut:cut + length])
                        keys.append(key)
                        pieces.append(n)
                    held += len(got)
                    if held >= block_tokens:
                        yield from flush()
        if ids:
            yield from flush()

    return read_columns(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(pack, SCHEMA)


def write_packed(packed: DataFrame, path: str) -> None:
    """Sequences as Parquet under ``path``: row groups of ids, lengths and positions."""
    packed.write.parquet(path)
