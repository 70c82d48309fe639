"""Front-end comparison (X1-X5) of two coupling tables.

first: (project, a, b, n_calls[, weight]) from the untyped front end (a < b);
second: the same from the typed front end (directed). The literal comparison keeps
``a -> b`` strings as they are; ``canonical=True`` folds both to unordered pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.functions import names as N
from callweave.operators.coupling import coupling_total


def compare_totals(first: DataFrame, second: DataFrame) -> DataFrame:
    """X1."""
    t1 = coupling_total(first).withColumnRenamed("total", "total_first")
    t2 = coupling_total(second).withColumnRenamed("total", "total_second")
    j = t1.join(t2, "project", "full")
    f, s = F.coalesce("total_first", F.lit(0)), F.coalesce("total_second", F.lit(0))
    return j.select("project", f.alias("total_first"), s.alias("total_second"), (s - f).alias("difference"))


def compare_classes(first: DataFrame, second: DataFrame) -> DataFrame:
    """Classes counted as distinct sources (matrix rows)."""
    c1 = first.groupBy("project").agg(F.countDistinct("a").alias("classes_first"))
    c2 = second.groupBy("project").agg(F.countDistinct("a").alias("classes_second"))
    j = c1.join(c2, "project", "full")
    f, s = F.coalesce("classes_first", F.lit(0)), F.coalesce("classes_second", F.lit(0))
    return j.select("project", f.alias("classes_first"), s.alias("classes_second"), (s - f).alias("difference"))


def _keys(df: DataFrame, canonical: bool) -> DataFrame:
    if canonical:
        a, b = N.canonical_pair("a", "b")
        return df.select("project", a.alias("a"), b.alias("b")).distinct()
    return df.select("project", "a", "b")


def compare_common(first: DataFrame, second: DataFrame, canonical: bool = False) -> DataFrame:
    """X3."""
    return _keys(first, canonical).intersect(_keys(second, canonical))


def compare_only_first(first: DataFrame, second: DataFrame, canonical: bool = False) -> DataFrame:
    """X4 (first side)."""
    return _keys(first, canonical).join(_keys(second, canonical), ["project", "a", "b"], "left_anti")


def compare_only_second(first: DataFrame, second: DataFrame, canonical: bool = False) -> DataFrame:
    """X4 (second side)."""
    return _keys(second, canonical).join(_keys(first, canonical), ["project", "a", "b"], "left_anti")


def compare_status(first: DataFrame, second: DataFrame, canonical: bool = True) -> DataFrame:
    """One full outer join, counts per status."""
    f = _keys(first, canonical).withColumn("_f", F.lit(True))
    s = _keys(second, canonical).withColumn("_s", F.lit(True))
    j = f.join(s, ["project", "a", "b"], "full")
    status = (F.when(F.col("_f") & F.col("_s"), "both").when(F.col("_f"), "first_only")
              .otherwise("second_only"))
    return j.groupBy("project", status.alias("status")).agg(F.count(F.lit(1)).alias("pairs"))
