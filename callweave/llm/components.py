"""Connected components of an edge table by alternating large-star and small-star steps
(Kiveris et al. 2014), with the edge table written between iterations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.llm.common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    turned = down.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return turned.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def _is_forest(edges: DataFrame) -> bool:
    """Whether the components are stars: no u has two edges or is the v of another one."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("down"), F.lit(0).alias("up")) \
        .unionByName(edges.select(F.col("v").alias("id"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    ends = ends.groupBy("id").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return ends.filter("down > 1 OR (down = 1 AND up = 1)").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) for every node of ``edges`` (a, b long); component is the smallest id.

    Loops and repeated edges are allowed; an empty table gives an empty result."""
    now = materialize(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u <> v")
                      .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "star")
    while not _is_forest(now):
        now = materialize(_small_star(_large_star(now)), "star")
    roots = now.select("v").distinct().select(F.col("v").alias("id"), F.col("v").alias("component"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
