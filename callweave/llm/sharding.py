"""Sharding by jump consistent hashing (Lamping & Veach 2014), in DataFrame functions only.

The key's generator state is kept as two 32-bit halves, because a 64-bit product overflows a
long under ANSI mode.  Law ``key``: the key and the number of shards decide the shard, and one
more shard only takes rows into itself.

Integral keys seed the generator as they are; other keys by their xxhash64.  Defined results:
a null key counts as 0; rows with equal keys share a shard; a null text has no bytes (size 1,
crc of the empty text); repeated rows get slots of their own; an empty table gives an empty
result.  The unrolled generator takes one step per shard at most (expected: ln(shards)).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.llm.common import materialize

_M32 = 0xFFFFFFFF
#: multiplier of the generator of the published algorithm, 2862933555777941757, in halves
_A_HI, _A_LO = 2862933555777941757 >> 32, 2862933555777941757 & _M32
#: groups in which slots are numbered, over all shards; each holds about rows / SLOT_GROUPS rows
SLOT_GROUPS = 32768
#: repetitions of one row that are numbered at once
STRETCH = 100_000


def _mul32(x: Column, y: int) -> Column:
    """x * y mod 2^32 for 32-bit halves; no partial product reaches 2^63."""
    hi, lo = F.shiftright(x, 16), x.bitwiseAND(F.lit(0xFFFF))
    return (F.shiftleft((hi * F.lit(y)).bitwiseAND(F.lit(0xFFFF)), 16) + lo * F.lit(y)).bitwiseAND(F.lit(_M32))


def _step(hi: Column, lo: Column) -> tuple[Column, Column]:
    """One step key = key * A + 1 (mod 2^64) on the halves of the key."""
    c, d = F.shiftright(lo, 16) * F.lit(_A_LO), lo.bitwiseAND(F.lit(0xFFFF)) * F.lit(_A_LO) + F.lit(1)
    low = d + F.shiftleft(c.bitwiseAND(F.lit(0xFFFF)), 16)
    carry = F.shiftright(low, 32) + F.shiftright(c, 16)
    high = (_mul32(hi, _A_LO) + _mul32(lo, _A_HI) + carry.bitwiseAND(F.lit(_M32))).bitwiseAND(F.lit(_M32))
    return high, low.bitwiseAND(F.lit(_M32))


def jump_hash(key: Column, shards: int) -> Column:
    """Shard (int) of a non-null long key among ``shards``."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    if shards == 1:
        return F.lit(0)
    start = F.struct(F.shiftrightunsigned(key, 32).alias("hi"), key.bitwiseAND(F.lit(_M32)).alias("lo"),
                     F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("next"))

    def jump(s: Column, _: Column) -> Column:
        hi, lo = _step(s["hi"], s["lo"])
        r = F.shiftrightunsigned(hi, 1) + F.lit(1)  # (key >> 33) + 1
        # next = floor((at + 1) * 2^31 / r), exact in whole numbers
        moved = F.struct(hi.alias("hi"), lo.alias("lo"), s["next"].alias("at"),
                         ((s["next"] + 1) * F.lit(1 << 31) - F.pmod((s["next"] + 1) * F.lit(1 << 31), r)).alias("p"),
                         r.alias("r"))
        return F.when(s["next"] < shards, F.struct(
            moved["hi"].alias("hi"), moved["lo"].alias("lo"), moved["at"].alias("at"),
            (moved["p"] / moved["r"]).cast("long").alias("next"))).otherwise(s)

    steps = F.sequence(F.lit(1), F.lit(shards))
    return F.aggregate(steps, start, jump, lambda s: s["at"].cast("int"))


def key_of(df: DataFrame, *keys: str) -> Column:
    """The 64-bit key: one integral column as it is, anything else hashed."""
    if len(keys) == 1 and isinstance(df.schema[keys[0]].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return F.coalesce(F.col(f"`{keys[0]}`").cast("long"), F.lit(0).cast("long"))
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


def with_shard(df: DataFrame, keys: list[str], shards: int, name: str = "shard") -> DataFrame:
    """``df`` with the shard of each row; nothing is shuffled."""
    return df.withColumn(name, jump_hash(key_of(df, *keys), shards))


def with_slots(rows: DataFrame, order: list[str], shards: int, groups: int = SLOT_GROUPS) -> DataFrame:
    """Adds ``slot``: a gapless number from 0 inside ``shard``.

    A shard is cut into hash groups; the groups' counts give each group its first slot (at most
    ``groups`` + ``shards`` rows, so they are handed to all tasks) and only a group is ever sorted
    by one task.  Identical rows are counted before they are grouped and numbered as one, so a
    row repeated any number of times does not make a group large."""
    per_shard = max(1, groups // shards)
    same = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_times")) \
        .withColumn("_group", F.pmod(F.xxhash64(*order), F.lit(per_shard)))
    same = materialize(same, "shard_rows")
    sizes = same.groupBy("shard", "_group").agg(F.sum("_times").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("shard", "_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("shard", "_group").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_first") + F.col("_before")
    placed = same.withColumn("_before", F.coalesce(F.sum("_times").over(inside), F.lit(0))) \
        .join(F.broadcast(first), ["shard", "_group"]).withColumn("_from", start).withColumn("_to", start + F.col("_times") - 1) \
        .drop("_group", "_before", "_first")
    # a row that is repeated very often is numbered in stretches, by many tasks
    often = placed.filter(F.col("_times") > STRETCH).withColumn("_at", F.explode(F.sequence("_from", "_to", F.lit(STRETCH).cast("long")))) \
        .withColumn("_to", F.least("_to", F.col("_at") + STRETCH - 1)).withColumn("_from", F.col("_at")).drop("_at") \
        .repartition("shard", "_from")
    return placed.filter(F.col("_times") <= STRETCH).unionByName(often) \
        .withColumn("slot", F.explode(F.sequence("_from", "_to"))).drop("_times", "_from", "_to")


def shard_documents(docs: DataFrame, shards: int) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every document.

    ``grown_shard`` is the shard after one more is appended.  Texts are read once and not shuffled."""
    text = F.coalesce(F.col("text"), F.lit(""))
    key = key_of(docs, "doc_id")
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), jump_hash(key, shards).alias("shard"),
                       jump_hash(key, shards + 1).alias("grown_shard"))
    return with_slots(rows, ["doc_id", "text_crc32", "size"], shards) \
        .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
