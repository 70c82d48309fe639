from pyspark.sql import functions as F

from callweave.functions.ranking import top_k_per_group, top_percent, with_global_index


def test_global_index_is_sorted_position(spark):
    df = spark.range(0, 500).select((F.col("id") * 7919 % 500).alias("v")).repartition(5)
    got = sorted((r.v, r.idx) for r in with_global_index(df, ["v"]).collect())
    assert got == [(v, v) for v in range(500)]


def test_top_percent_and_top_k(spark):
    rows = [("p", i, i % 13) for i in range(101)] + [("q", i, 1) for i in range(3)]
    df = spark.createDataFrame(rows, "g string, id long, v long")
    t = top_percent(df, ["g"], [F.col("v").desc(), F.col("id")], 0.1)
    counts = {r.g: r.c for r in t.groupBy("g").agg(F.count("*").alias("c")).collect()}
    assert counts == {"p": 11, "q": 1}
    k = top_k_per_group(df, ["g"], [F.col("v").desc(), F.col("id")], 5)
    assert sorted(r.id for r in k.filter("g = 'p'").collect()) == [12, 25, 38, 51, 64]


def _rows_per_task(df):
    from pyspark.sql import functions as F
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())


def test_one_project_with_all_rows_stays_spread(spark):
    """Group positions and project totals with a single project: no task holds most of the rows."""
    from pyspark.sql import functions as F

    from callweave.functions.ranking import spread_join, with_group_position
    from callweave.operators.coupling import coupling_weights
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                             "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        n = 40_000
        df = spark.range(n).select(F.lit("p").alias("project"), F.format_string("c%06d", "id").alias("a"),
                                   F.lit("z").alias("b"), F.lit(1).cast("long").alias("n_calls"))
        pos = with_group_position(df, ["project"], ["a"], "pos", "size")
        assert pos.filter("a <> format_string('c%06d', pos) OR size <> 40000").count() == 0
        for out in (pos, coupling_weights(df), spread_join(df, spark.createDataFrame([("p", 1)], "project string, t int"),
                                                           ["project"])):
            parts = _rows_per_task(out)
            assert sum(parts) == n and parts[-1] <= 0.4 * n, parts
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
