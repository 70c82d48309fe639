"""Code model of many projects, derived from the driver tables.

The number of projects and of classes grows with the ``part`` table; the project ``hub`` holds a third of all
methods (and of all calls), the others share the rest.  Method names recur between projects, so every
step must keep projects apart.  The rule is fixed, so that an SQL engine can derive the same tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callweave.session import materialize
from callweave.sources.fixtures import consecutive_part_pairs
from callweave.sources.tables import read_table

#: parts per project and per class number
PARTS_PER_PROJECT, PARTS_PER_CLASS = 500, 30


def _method_name(key):
    return F.when(key % 50 == 0, "get").otherwise(F.concat(F.lit("m"), F.floor(key / 3).cast("string")))


def corpus_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """methods(project, package, class_name, class_fqn, method_ord, method, method_fqn, loc, params)."""
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_size")
    n = part.count()
    projects, classes = max(3, n // PARTS_PER_PROJECT), n // PARTS_PER_CLASS + 1
    k = F.col("p_partkey")
    c = k * 11 % classes
    project = F.when(k % 3 == 0, "hub").otherwise(F.concat(F.lit("proj"), (k % projects).cast("string")))
    rows = part.select(project.alias("project"), F.concat(project, F.lit(".p"), (c % 4).cast("string")).alias("package"),
                       F.concat(F.lit("C"), c.cast("string")).alias("class_name"), k.alias("method_ord"), _method_name(k).alias("method"),
                       F.col("p_size").alias("loc"), (k % 7).cast("int").alias("params"))
    rows = rows.withColumn("class_fqn", F.concat_ws(".", "package", "class_name"))
    return rows.withColumn("method_fqn", F.concat_ws(".", "class_fqn", "method"))


def corpus_invocations(spark: SparkSession, sf_dir: str, methods: DataFrame) -> DataFrame:
    """invocations(project, caller, callee_simple), distinct: a method calls the name of the next line's part."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    pairs = consecutive_part_pairs(li)
    # until the rows are distinct a caller is its number: the smallest line of the methods of its name
    named = methods.select("project", F.col("method_fqn").alias("caller"), F.col("method_ord").alias("l_partkey"))
    callers = materialize(named.groupBy("project", "caller").agg(F.min("l_partkey").alias("_no")), "callers")
    # (a name follows from its line, so no line has two names and no number is that of two)
    a = named.join(callers, ["project", "caller"]).select("project", "l_partkey", "_no").distinct()
    rows = pairs.join(a, "l_partkey").select("project", "_no", _method_name(F.col("nx")).alias("callee_simple")).distinct()
    return rows.join(callers, ["project", "_no"]).select("project", "caller", "callee_simple")
