"""Heavy names, as-of joins, joined cells and class sets against plain forms, with hot keys."""

import random

import pytest
from pyspark.sql import functions as F

from callweave.functions import ranking as RK
from callweave.operators import cluster as CL
from callweave.operators import modules as MO
from callweave.operators import resolve as R
from callweave.sources.typed import receiver_types


@pytest.fixture
def no_aqe(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def largest_share(df):
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


def test_split_join_keeps_a_heavy_name_spread(spark, no_aqe):
    rows = spark.range(0, 40_000, 1, 8).selectExpr(
        "'p' AS project", "CASE WHEN id % 2 = 0 THEN 'run' WHEN id % 50 = 1 THEN NULL ELSE concat('m', id % 3000) END AS name", "id")
    table = spark.range(3000).selectExpr("'p' AS project", "concat('m', id) AS name", "id AS v") \
        .unionByName(spark.createDataFrame([("p", "run", -1)], "project string, name string, v long"))
    got = RK.split_join(rows, table, ["project", "name"])
    assert largest_share(got) <= 0.4
    assert [r.name for r in RK.heavy_keys(rows, ["project", "name"]).collect()] == ["run"]
    want = rows.join(table, ["project", "name"], "left")
    assert got.exceptAll(want.select(*got.columns)).isEmpty() and got.count() == 40_000
    inner = RK.split_join(rows, table, ["project", "name"], "inner")
    assert inner.count() == rows.join(table, ["project", "name"]).count()


def test_calls_of_one_name_are_resolved_by_many_tasks(spark, no_aqe):
    methods = spark.range(400).selectExpr("'p' AS project", "concat('a.C', id) AS class_fqn", "concat('m', id) AS method",
                                          "concat('a.C', id, '.m', id) AS method_fqn", "id AS file_ord", "0L AS method_ord")
    inv = spark.range(0, 20_000, 1, 8).selectExpr("'p' AS project", "concat('a.C1.x', id) AS caller", "500L AS file_ord", "id AS method_ord",
                                                  "CASE WHEN id % 2 = 0 THEN 'm7' ELSE concat('m', id % 400) END AS callee_simple")
    for resolved in (R.resolve_global(inv, methods), R.resolve_sequential(inv, methods)):
        assert {(r.caller, r.callee) for r in resolved.collect()} == {
            (f"a.C1.x{i}", f"a.C{7 if i % 2 == 0 else i % 400}.m{7 if i % 2 == 0 else i % 400}") for i in range(20_000)}


def test_asof_join_with_a_hot_variable(spark, no_aqe):
    rng = random.Random(1)
    pick = lambda: rng.choice(["hot"] * 5 + list("abcde") + [None])
    calls = [(pick(), rng.randrange(300), i) for i in range(3000)]
    decls = sorted({(pick(), rng.randrange(300)) for _ in range(600)}, key=str)
    decls = [(v, p, f"t{i}" if i % 7 else None) for i, (v, p) in enumerate(decls)]
    left = spark.createDataFrame(calls, "variable string, at long, id long")
    right = spark.createDataFrame(decls, "variable string, since long, type string")
    got = RK.asof_join(left, right, ["variable"], F.col("at"), F.col("since"), ["type"])
    assert largest_share(got) <= 0.4
    for r in got.collect():
        known = [(p, t) for v, p, t in decls if v is not None and v == r.variable and p <= r.at]
        assert r.type == (max(known, key=lambda x: x[0])[1] if known else None), r
    assert got.count() == 3000
    empty = RK.asof_join(left, right.limit(0), ["variable"], F.col("at"), F.col("since"), ["type"])
    assert empty.filter("type IS NULL").count() == 3000


def test_cells_go_on_in_parts(spark):
    rows = [("p", g, f"c{i:04d}") for g, n in (("a", 2500), ("b", 1), ("c", 1000)) for i in range(n)]
    df = spark.createDataFrame(rows, "project string, g string, item string").repartition(5)
    for size in (100_000, 700, 1000):
        got = RK.ordered_cells(df, ["project", "g"], "item", ";", "cell", size).orderBy("g", "part").collect()
        assert all(len(r.cell.split(";")) <= size for r in got)
        for g in "abc":
            assert ";".join(r.cell for r in got if r.g == g) == ";".join(c for _, k, c in rows if k == g)


def test_class_sets_of_all_nodes(spark, monkeypatch):
    monkeypatch.setattr(MO, "_CHUNK_LEAVES", 4)
    rng = random.Random(2)
    rows = [(p, f"c{a:02d}", f"c{b:02d}", rng.randint(1, 5)) for p, n in (("x", 14), ("y", 5))
            for a in range(n) for b in range(a + 1, n) if rng.random() < 0.3]
    d = CL.dendrogram(spark.createDataFrame(rows, "project string, a string, b string, n long"))
    nodes = MO.cut(d, 0.1)["nodes"]
    flat = {(r.project, r.node_id): r for r in nodes.collect()}

    def below(p, i):
        r = flat[p, i]
        return {r.label} if r.left is None else below(p, r.left) | below(p, r.right)

    got = {}
    for r in MO.node_classes(nodes).collect():
        got.setdefault((r.project, r.node_id), []).append(r.class_fqn)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(below(*k)) for k in flat}
    some = nodes.filter("node_id % 2 = 0")
    assert {(r.project, r.node_id) for r in MO.node_classes(nodes, some).collect()} == {k for k in flat if k[1] % 2 == 0}
    whole = {(r.project, r.node_id): r.text for r in MO.dendrogram_detailed(nodes).collect()}
    parts = MO.dendrogram_detailed(nodes, cell_items=2).orderBy("part").collect()
    assert whole == {k: "".join(r.text for r in parts if (r.project, r.node_id) == k) for k in flat}


def test_receiver_types_follow_chains(spark):
    members = [("p", "A", "field", "b", "B"), ("p", "B", "call", "next", "A"), ("p", "A", "call", "self", "A"), ("q", "A", "field", "b", "Z")]
    variables = [("p", "A.run", "x", "B"), ("p", "A.run", "b", "java.util.List")]
    exprs = [("p", "1", None, "this", None, "A.run", "A"), ("p", "2", "1", "field", "b", "A.run", "A"), ("p", "3", "2", "call", "next", "A.run", "A"),
             ("p", "4", "3", "field", "b", "A.run", "A"), ("p", "5", None, "name", "x", "A.run", "A"), ("p", "6", "5", "call", "next", "A.run", "A"),
             ("p", "7", None, "name", "b", "A.run", "A"), ("p", "8", None, "name", "b", "A.go", "A"), ("p", "9", None, "name", "none", "A.go", "A"),
             ("p", "10", "9", "call", "next", "A.go", "A"), ("p", "11", None, "call", "self", "A.go", "A"), ("p", "12", "5", "field", "b", "A.run", "A")]
    got = receiver_types(spark.createDataFrame(exprs, "project string, expr_id string, receiver_id string, kind string, name string, scope string, class_fqn string"),
                         spark.createDataFrame(members, "project string, class_fqn string, kind string, name string, type_fqn string"),
                         spark.createDataFrame(variables, "project string, scope string, name string, type_fqn string"))
    assert {r.expr_id: r.type_fqn for r in got.collect()} == {
        "1": "A", "2": "B", "3": "A", "4": "B", "5": "B", "6": "A", "7": "java.util.List", "8": "B", "11": "A"}
