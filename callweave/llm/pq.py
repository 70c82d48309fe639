"""Product quantisation of vectors in exact integer arithmetic.

Components become integers (floor of ``scale`` times the component); a vector is cut into equal
parts, and every part has its own codebook.  Distances come from dot products computed by a
limb-split GEMM: integers are broken into limbs so small that a float64 BLAS product of two limbs
stays below 2^53 and is exact; the products are shifted and added in int64.  The nearest entry is the
first argmin, so results do not depend on batches, tasks or the BLAS.

Each round is one scan of the written integer table; a task reduces its rows to sums and counts
per part, entry and position (codebook-sized), which are added up by Spark, so no group of vectors,
however large, is gathered.  What reaches the driver is as large as the codebooks.

Defined results: rows whose vector is null or holds a null or non-finite component are dropped;
null ids come last among the ids that seed the codebooks and are encoded like others; of equal ids
the smaller integer vector counts first; with fewer kept rows than entries the codebooks are
smaller; vectors without components have error 0; a null label is a label of its own; repeated
rows are encoded each; an empty table gives an empty result; other columns are ignored.  Refused,
with a ValueError, since no exact answer fits a long: vectors of different lengths or of a length that the parts do not
divide, integers of 2^46 or more in size, and ranges whose squared distances could reach 2^63.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.llm.common import join_counted, materialize

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
_MANTISSA = 53
_COMPONENT_BITS = 46
#: sums of a task leave it after this many vectors, which keeps them below 2^63
_FLUSH_ROWS = 1 << 16


# --- exact products ----------------------------------------------------------------------------
def limb_bits(inner: int) -> int:
    """Bits of a limb so that a sum of ``inner`` products of two limbs stays below 2^53."""
    return (_MANTISSA - max(inner, 1).bit_length()) // 2


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """float64 matrices l with x = sum of l[i] * 2^(i * bits); all but the highest are >= 0."""
    out, rest = [], x.astype(np.int64, copy=True)
    while len(rest) and rest.size and (rest.max() >= 1 << bits or rest.min() < -(1 << bits)):
        out.append((rest & ((1 << bits) - 1)).astype(np.float64))
        rest >>= bits
    return [*out, rest.astype(np.float64)]


def exact_products(x: np.ndarray, c: np.ndarray, bits: int | None = None) -> np.ndarray:
    """``x @ c.T`` of int64 matrices, modulo 2^64."""
    bits = bits or limb_bits(x.shape[1])
    out = np.zeros((len(x), len(c)), dtype=np.int64)
    right = limbs(c, bits)
    for i, a in enumerate(limbs(x, bits)):
        for j, b in enumerate(right):
            if (i + j) * bits < 64:
                out += (a @ b.T).astype(np.int64) << ((i + j) * bits)
    return out


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest row of ``c``, squared distance) for each row of ``x``; ties to the lower index.

    All terms are taken modulo 2^64; a distance below 2^63 comes out exactly."""
    d = (x * x).sum(axis=1)[:, None] - 2 * exact_products(x, c) + (c * c).sum(axis=1)[None, :]
    at = d.argmin(axis=1)
    return at, d[np.arange(len(x)), at]


# --- tables ----------------------------------------------------------------------------------
_SIGN = np.uint64(1 << 63)


def _binary(matrix: np.ndarray) -> pa.Array:
    """One binary value per row, whose bytes order like the integers: big-endian, sign bit flipped."""
    n, width = len(matrix), matrix.shape[1] * 8
    ends = pa.py_buffer((np.arange(n + 1, dtype=np.int64) * width).tobytes())
    data = pa.py_buffer((np.ascontiguousarray(matrix).view(np.uint64) ^ _SIGN).astype(">u8").tobytes())
    return pa.Array.from_buffers(pa.large_binary(), n, [None, ends, data]).cast(pa.binary())


def _decode(raw, dim: int) -> np.ndarray:
    values = (np.frombuffer(raw, dtype=">u8").astype(np.uint64) ^ _SIGN).view(np.int64)
    return values.reshape(-1, dim) if dim else np.zeros((0, 0), dtype=np.int64)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    values = column.buffers()[2]
    if not dim or values is None:
        return np.zeros((len(column), dim), dtype=np.int64)
    return _decode(memoryview(values)[offsets[0]:offsets[-1]], dim)


def _integers(scale: int):
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v").cast(pa.large_list(pa.float64()))
            whole = np.asarray(lists.is_valid())
            offsets = np.asarray(lists.offsets)
            values = lists.values.to_numpy(zero_copy_only=False)
            bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
            keep = np.flatnonzero(whole & (bad[offsets[1:]] == bad[offsets[:-1]]))
            size = (offsets[1:] - offsets[:-1])[keep]
            for dim in np.unique(size).tolist():
                rows = keep[size == dim]
                x = values[offsets[rows][:, None] + np.arange(dim)[None, :]] if dim else np.zeros((len(rows), 0))
                x = np.floor(x * scale)
                if x.size and np.abs(x).max() >= 2.0 ** _COMPONENT_BITS:
                    raise ValueError(f"a component times {scale} has {_COMPONENT_BITS} bits or more")
                some = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(some), batch.column("label").take(some), pa.array(np.full(len(rows), dim), pa.int32()),
                     _binary(x.astype(np.int64))], names=["vec_id", "label", "dim", "q"])
    return run


@dataclass
class Codebooks:
    """``entries[part]`` is an int64 matrix, one row per entry."""
    entries: list[np.ndarray]

    @property
    def dim(self) -> int:
        return sum(e.shape[1] for e in self.entries)

    def sha256(self) -> str:
        values = [str(v) for e in self.entries for v in e.ravel().tolist()]
        return hashlib.sha256(",".join(values).encode()).hexdigest()

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(indices, squared distances) of every part of every row."""
        at = np.empty((len(x), len(self.entries)), dtype=np.int64)
        far = np.empty_like(at)
        lo = 0
        for p, c in enumerate(self.entries):
            part = x[:, lo:lo + c.shape[1]]
            lo += c.shape[1]
            if part.size:
                reach = int(max(part.max(), c.max())) - int(min(part.min(), c.min()))
                if reach * reach * self.dim >= 1 << 63:
                    raise ValueError("squared distances may reach 2^63")
            at[:, p], far[:, p] = nearest(part, c)
        return at, far


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    scale: int = SCALE) -> DataFrame:
    """(vec_id, label, dim, q) of the rows with whole finite vectors, written once; ``q`` holds
    the integers."""
    src = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("long").alias("label"),
                         F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    return materialize(src.mapInArrow(_integers(scale), "vec_id long, label long, dim int, q binary"), "integer_vectors")


def _partial_sums(books: Codebooks):
    dim = books.dim

    def run(batches) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(e.shape, dtype=np.int64) for e in books.entries]
        counts = [np.zeros(len(e), dtype=np.int64) for e in books.entries]
        held = 0

        def leave():
            rows = [(p, e, j, v, int(counts[p][e])) for p, s in enumerate(sums) for e in np.flatnonzero(counts[p]).tolist()
                    for j, v in enumerate(s[e].tolist())]
            for s, c in zip(sums, counts):
                s[:], c[:] = 0, 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
                    pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))], names=["p", "e", "j", "total", "n"])

        for batch in batches:
            for lo in range(0, batch.num_rows, _FLUSH_ROWS):
                x = _matrix(batch.column("q").slice(lo, _FLUSH_ROWS), dim)
                if held + len(x) > _FLUSH_ROWS:
                    yield from leave()
                    held = 0
                held += len(x)
                at, _ = books.assign(x)
                lo_dim = 0
                for p, s in enumerate(sums):
                    part = x[:, lo_dim:lo_dim + s.shape[1]]
                    lo_dim += s.shape[1]
                    counts[p] += np.bincount(at[:, p], minlength=len(s))
                    for e in np.unique(at[:, p]).tolist():
                        s[e] += part[at[:, p] == e].sum(axis=0)
        yield from leave()
    return run


def train_codebooks(integers: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks after ``rounds`` rounds of Lloyd's iteration with floored means; None for no vectors.

    They start as the parts of the ``entries`` smallest ids; an entry that no vector chooses stays."""
    low, high = integers.agg(F.min("dim"), F.max("dim")).first()
    if low is None:
        return None
    if low != high or low % parts:
        raise ValueError(f"vectors have {low} to {high} components; one number divisible by {parts} is needed")
    first = integers.orderBy(F.col("vec_id").asc_nulls_last(), "q").select("q").limit(entries).collect()
    seeds = _decode(b"".join(r["q"] for r in first), low)
    if not low:
        seeds = np.zeros((len(first), 0), dtype=np.int64)
    width = low // parts
    books = Codebooks([seeds[:, p * width:(p + 1) * width].copy() for p in range(parts)])
    for _ in range(rounds if width else 0):
        sums = integers.select("q").mapInArrow(_partial_sums(books), "p int, e int, j int, total long, n long") \
            .groupBy("p", "e", "j").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
        for r in sums.collect():
            books.entries[r["p"]][r["e"], r["j"]] = int(r["total"]) // r["n"]
    return books


def encode(integers: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, label, code, error): indices of the nearest entries as two hex digits per part, and the
    squared distances summed over the parts."""
    dim = books.dim

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, far = books.assign(_matrix(batch.column("q"), dim))
            text = at.astype(np.uint8).tobytes().hex()
            step = 2 * at.shape[1]
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), batch.column("label"),
                pa.array([text[i:i + step] for i in range(0, len(text), step)], pa.string()),
                pa.array(far.sum(axis=1), pa.int64())], names=["vec_id", "label", "code", "error"])

    return integers.select("vec_id", "label", "q").mapInArrow(run, "vec_id long, label long, code string, error long")


def quantise(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) of every kept vector."""
    if not 1 <= entries <= 256:
        raise ValueError("entries must be 1 to 256: a code has two hex digits")
    spark = vectors.sparkSession
    integers = integer_vectors(vectors, id_col, vector_col, label_col, scale)
    books = train_codebooks(integers, parts, entries, rounds)
    if books is None:
        return spark.createDataFrame([], "vec_id long, label long, code string, error long, label_error long, codebooks_sha256 string")
    codes = materialize(encode(integers, books).withColumn("unlabelled", F.col("label").isNull())
                        .withColumn("group", F.coalesce("label", F.lit(0))), "codes")
    sums = codes.groupBy("unlabelled", "group").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n"))
    return join_counted(codes, materialize(sums, "label_errors"), ["unlabelled", "group"], "n") \
        .select("vec_id", "label", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
