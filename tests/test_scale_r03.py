"""Steps that must stay spread, narrow or whole on large tables."""

from pyspark.sql import functions as F

from tests.conftest import SF0001


def _hash_exchanges(df):
    return [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "hashpartitioning(" in x]


def test_extraction_is_dealt_over_tasks(spark):
    from callweave.sources.extract import extract_facts
    rows = [("p", f"C{i}.java", f"package q;\nclass C{i} {{ void m() {{ a(); }} }}") for i in range(64)]
    sources = spark.createDataFrame(rows, "project string, path string, text string").coalesce(1)
    facts = extract_facts(sources)
    assert facts.select(F.spark_partition_id().alias("t")).distinct().count() > 4
    assert facts.filter("kind = 'inv'").count() == 64


def test_invocations_are_not_shuffled_with_their_names(spark):
    from callweave.sources import fixtures as FX
    inv = FX.fixture_invocations(spark, SF0001, FX.fixture_methods(spark, SF0001))
    assert not [x for x in _hash_exchanges(inv) if "callee_true" in x or "callee_class" in x]
    assert inv.count() == inv.distinct().count()


def test_classes_of_calls_are_distinct_before_they_are_judged(spark):
    from callweave.plans.catalog import QUERIES
    found = QUERIES["project_classes"](spark, SF0001)
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    semi = next(i for i, x in enumerate(plan) if "Join LeftSemi" in x)
    assert "Aggregate [" in plan[semi + 1]


def test_expressions_of_a_round_are_joined_once(spark, monkeypatch):
    from callweave.sources import typed
    written, keep = [], typed.materialize
    monkeypatch.setattr(typed, "materialize", lambda df, name="t": written.append(name) or keep(df, name))
    exprs = [("p", "e0", None, "this", None, "m", "A"), ("p", "e1", "e0", "field", "x", "m", "A"), ("p", "e2", "e1", "call", "y", "m", "A"),
             ("p", "e3", "e1", "call", "none", "m", "A"), ("p", "e4", "e3", "call", "y", "m", "A")]
    got = typed.receiver_types(
        spark.createDataFrame(exprs, "project string, expr_id string, receiver_id string, kind string, name string, scope string, class_fqn string"),
        spark.createDataFrame([("p", "A", "field", "x", "B"), ("p", "B", "call", "y", "C")], "project string, class_fqn string, kind string, name string, type_fqn string"),
        spark.createDataFrame([], "project string, scope string, name string, type_fqn string"))
    assert {(r.expr_id, r.type_fqn) for r in got.collect()} == {("e0", "A"), ("e1", "B"), ("e2", "C")}
    assert "met_exprs" in written and written.count("chained_exprs") == 1


def test_receivers_are_written_before_they_are_split(spark, monkeypatch):
    from callweave.operators import resolve
    written, keep = [], resolve.materialize
    monkeypatch.setattr(resolve, "materialize", lambda df, name="t": written.append(name) or keep(df, name))
    inv = spark.createDataFrame([("p", "A.m", 1, "item", "run"), ("p", "A.m", 1, "b", "go"), ("p", "A.m", 1, None, "x")],
                                "project string, caller string, file_ord long, receiver string, callee_simple string")
    classes = spark.createDataFrame([("p", "q.A"), ("p", "q.B")], "project string, class_fqn string")
    variables = spark.createDataFrame([("p", 1, 1, "item", "A")], "project string, file_ord long, decl_ord long, variable string, type_name string")
    got = resolve.resolve_by_receiver(inv, classes, variables)
    assert {(r.receiver, r.callee_inferred) for r in got.collect()} == {("item", "q.A.run"), ("b", "q.B.go"), (None, None)}
    assert written == ["receivers", "receiver_types"]


def test_file_order_leaves_texts_in_their_files(spark, monkeypatch):
    from callweave.functions import ranking
    from callweave.sources.extract import with_file_order
    written, keep = [], ranking.materialize
    monkeypatch.setattr(ranking, "materialize", lambda df, name="t": written.append(df.columns) or keep(df, name))
    sources = spark.createDataFrame([("p", "b", "B"), ("p", "a", "A"), ("q", "c", None)], "project string, path string, text string")
    assert {tuple(r) for r in with_file_order(sources).select("project", "path", "text", "file_ord").collect()} == {
        ("p", "a", "A", 0), ("p", "b", "B", 1), ("q", "c", None, 0)}
    assert written and not any("text" in c for c in written)


def test_scan_sources_counts_every_unit(spark):
    from callweave.plans.catalog import QUERIES
    from callweave.plans.context import analysis
    m = analysis(spark, SF0001).methods
    row = QUERIES["scan_sources"](spark, SF0001).first()
    assert row.files == m.count() + m.select("class_fqn").distinct().count()
    assert row.name_chars == m.agg(F.sum(F.length("method"))).first()[0]


def test_texts_go_to_python_in_small_batches(spark):
    from callweave.llm.common import table
    from callweave.session import BATCH_BYTES
    table(spark, SF0001, "documents")

    def sizes(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes], pa.int64())], names=["n"])

    texts = spark.range(40, numPartitions=1).select(F.expr("repeat('x', 1 << 20)").alias("text"))
    found = [r.n for r in texts.mapInArrow(sizes, "n long").collect()]
    assert sum(found) >= 40 << 20 and max(found) <= BATCH_BYTES + (2 << 20)


def test_a_graph_of_equal_pairs_takes_one_block(spark):
    from callweave.operators.cluster import merges_rounds
    n = 460
    line = spark.range(n * n, numPartitions=2)
    eid = line.select(F.lit("p").alias("project"), F.floor(F.col("id") / n).alias("a"), (F.col("id") % n).alias("b"),
                      F.lit(1).cast("long").alias("s")).filter("a < b")
    counts = spark.createDataFrame([("p", n, n * (n - 1) // 2)], "project string, n long, n_edges long")
    merges, steps = merges_rounds(eid, counts)
    assert merges.count() == n - 1 and steps == 1


def test_next_lines_are_found_without_a_join(spark):
    from callweave.sources.fixtures import consecutive_part_pairs
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    kept = spark.conf.get(key)
    spark.conf.set(key, "false")  # so that the long order spans tasks
    try:
        rows = [(1, i, i + 100, 0) for i in range(400)] + [(2, 0, 7, 0), (2, 1, None, 0), (2, 2, 7, 1), (None, 0, 7, 0), (None, 1, 8, 0),
                                                           (3, 0, 5, 0), (3, 0, 5, 0), (3, 0, 6, 0), (4, 0, 9, 0)]
        li = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long")
        pairs = consecutive_part_pairs(li)
        assert "Join" not in pairs._jdf.queryExecution().optimizedPlan().toString()
        got = [tuple(r) for r in pairs.collect()]
    finally:
        spark.conf.set(key, kept)
    assert len(got) == len(set(got))
    assert set(got) == {(i + 100, i + 101) for i in range(399)} | {(7, None), (None, 7), (5, 5), (5, 6)}


def test_corpus_callers_are_numbers_until_they_are_distinct(spark):
    from callweave.sources.corpus import corpus_invocations, corpus_methods
    inv = corpus_invocations(spark, SF0001, corpus_methods(spark, SF0001))
    assert not [x for x in _hash_exchanges(inv) if "caller#" in x and "callee_simple#" in x]
    assert inv.count() == inv.distinct().count()


def test_bodies_of_methods_are_written_once_for_all_sources(spark, monkeypatch):
    from callweave import session
    from callweave.plans.catalog import QUERIES
    from callweave.plans.context import Analysis, _CONTEXTS
    from callweave.sources.render import method_bodies
    inv = spark.createDataFrame([("p", 1, "b"), ("p", 1, "a"), ("p", 1, "b"), ("p", 2, None), ("q", 1, "c")],
                                "project string, method_ord long, callee_simple string")
    bodies = method_bodies(inv)
    assert len(_hash_exchanges(bodies)) == 1
    assert {tuple(r) for r in bodies.collect()} == {("p", 1, "a(); b();"), ("p", 2, ""), ("q", 1, "c();")}
    written, keep = [], session.materialize
    monkeypatch.setattr(session, "materialize", lambda df, name="t": written.append(name) or keep(df, name))
    monkeypatch.setitem(_CONTEXTS, (id(spark), SF0001), Analysis(spark, SF0001))
    assert QUERIES["scan_sources"](spark, SF0001).count() == 1
    assert written.count("method_bodies") == 1
