"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callweave.session import bound_batches, materialize

__all__ = ["materialize", "held_out", "documents", "table", "read_columns", "bounded", "space_word_array", "join_counted", "text_key", "free_name"]

#: `[^\x20\x09-\x0D]+` as the separators of a Java split
SPACES = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def read_columns(df: DataFrame, *cols: str) -> DataFrame:
    """Only the named columns, so extra columns with clashing names never reach an operator."""
    return df.select(*[F.col(f"`{c}`") for c in cols])


def held_out(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 5 is 0; a null id counts as the empty text (crc 0: held out)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def space_word_array(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def free_name(df: DataFrame, base: str) -> str:
    """``base``, or ``base`` with underscores, so that no column of ``df`` has that name in any case."""
    used = {c.lower() for c in df.columns}
    while base.lower() in used:
        base += "_"
    return base


def text_key(text: Column) -> list[Column]:
    """120 bits of a text's MD5 as two longs, ``k1`` and ``k2``."""
    md5 = F.md5(text)
    return [F.conv(F.substring(md5, at, 15), 16, 10).cast("long").alias(name) for at, name in ((1, "k1"), (17, "k2"))]


def bounded(n: int, limit: int, what: str) -> None:
    if n > limit:
        raise ValueError(f"{what}: {n} exceeds the documented bound {limit}")


#: keys that hold more than one in this many rows are joined by broadcast: there are fewer than this
HOT_KEYS = 4096


def join_counted(rows: DataFrame, table: DataFrame, keys: list[str], count: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table``, which has one row per key and in ``count`` the key's number of rows.

    Keys above a ``HOT_KEYS``-th of all counted rows are fewer than ``HOT_KEYS`` whatever the data, so
    their side is broadcast and their rows stay where they are; all others are joined by key, where no
    key holds more than that share.  Both tables are read twice and should be written ones."""
    total = table.agg(F.sum(count)).first()[0] or 0
    hot = F.broadcast(table.filter(F.col(count) > total // HOT_KEYS + 1))
    some = rows.join(hot, keys)
    rest = rows.join(hot.select(*keys), keys, "left_anti") \
        .join(table.filter(F.col(count) <= total // HOT_KEYS + 1), keys, how)
    return some.unionByName(rest)


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """Up to ``per_class`` labelled documents of each class outside the held-out fold, and the
    classes' sizes among all such labels.

    The labelled ids are drawn by hash order, so the draw is the same on every run; the drawn
    ids (2 * per_class rows at most) are handed to every task and only their texts are shuffled.  Of
    several labels of one id the largest counts, of several texts of one id the least, so the sample has one row
    per drawn id; null ids and null labels are not drawn."""
    value = F.col(column).cast("int")
    known = read_columns(labels, "doc_id", column).filter(value.isin(0, 1) & F.col("doc_id").isNotNull()
                                                          & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max(value).alias("label"))
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    drawn = known.filter("label = 0").orderBy(*order).limit(per_class) \
        .unionByName(known.filter("label = 1").orderBy(*order).limit(per_class))
    rows = read_columns(docs, "doc_id", "text").join(F.broadcast(drawn), "doc_id")
    return rows.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("doc_id", "text", "label"), sizes
