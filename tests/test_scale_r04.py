"""Steps that must leave the driver small or take graphs of any size at once."""

from pyspark.sql import functions as F

from tests.conftest import SF0001


def test_resolution_of_scanned_files_reads_no_texts(spark):
    from callweave.plans.catalog import QUERIES
    from callweave.sources.extract import with_file_order
    sources = spark.createDataFrame([("p", "b", "B"), ("p", "a", "A"), ("q", "c", None)], "project string, path string, text string")
    assert {tuple(r) for r in with_file_order(sources).places.collect()} == {("p", "a", 0), ("p", "b", 1), ("q", "c", 0)}
    found = QUERIES["resolve_sequential_scanned"](spark, SF0001)
    assert "FileScan text" not in found._jdf.queryExecution().executedPlan().toString()
    read = {f.split("/callweave-tables/")[-1].split("/")[0].rsplit("-", 1)[0] for f in found.inputFiles()}
    assert {"ordered_calls", "ordered_methods"} <= read and not {"scan", "scanned_facts", "file_order"} & read, read
    assert found.count() == found.distinct().count() > 0


def test_a_graph_of_millions_of_edges_takes_one_block(spark):
    from callweave.operators.cluster import merges_rounds
    n = 2100  # 4.4 million incident edges
    line = spark.range(n * n, numPartitions=4)
    eid = line.select(F.lit("p").alias("project"), F.floor(F.col("id") / n).alias("a"), (F.col("id") % n).alias("b"),
                      F.lit(1).cast("long").alias("s")).filter("a < b")
    counts = spark.createDataFrame([("p", n, n * (n - 1) // 2)], "project string, n long, n_edges long")
    merges, steps = merges_rounds(eid, counts)
    assert merges.count() == n - 1 and steps == 1


def test_names_are_not_broadcast(spark):
    from callweave.operators.resolve import resolve_sequential
    methods = spark.createDataFrame([("p", f"A{i % 3}", f"m{i % 5}", i, i) for i in range(9)],
                                    "project string, class_fqn string, method string, file_ord long, method_ord long")
    calls = spark.createDataFrame([("p", "A0.m0", 2, 2, f"m{i}") for i in range(6)],
                                  "project string, caller string, file_ord long, method_ord long, callee_simple string")
    found = resolve_sequential(calls, methods)
    assert {r.callee for r in found.collect()} == {"A0.m0", "A1.m1", "A2.m2", "m3", "A1.m4", "m5"}
    run = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
    assert not [x for x in run if "BroadcastHashJoin" in x and "method#" in x and "LeftSemi" not in x], run
    assert any("SortMergeJoin" in x for x in run)
