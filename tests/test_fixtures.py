import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from callweave.sources.fixtures import consecutive_part_pairs


def test_consecutive_pairs_with_a_hot_order(spark):
    rng = random.Random(5)
    rows = [(1, rng.randint(0, 30), rng.randint(0, 3), i % 7) for i in range(3000)]  # one order, 3000 lines
    rows += [(o, rng.randint(0, 30), rng.randint(0, 3), ln) for o in range(2, 300) for ln in range(rng.randint(1, 7))]
    li = spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int") \
        .repartition(7)
    got = sorted(tuple(r) for r in consecutive_part_pairs(li).collect())
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    ref = (li.select("l_partkey", F.lead("l_partkey").over(w).alias("nx")).filter("nx IS NOT NULL").distinct())
    assert got == sorted(tuple(r) for r in ref.collect())
