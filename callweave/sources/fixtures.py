"""Code-model tables derived from the driver tables.

One method per ``part`` row (package = type, class = brand), calls between
consecutive lines of one order. The mapping is a fixed rule so that an SQL engine
can derive the same tables (see ``plans/oracle.py``).

Scale notes: consecutive lines are neighbours in range-sorted partitions (no window
per order, so a hot order is split);
distinct (caller part, callee part) pairs are reduced with a partial aggregate
before the two joins to the method table, which AQE broadcasts or sort-merges
depending on its runtime size.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from callweave.functions import names as N
from callweave.functions.ranking import with_group_position
from callweave.session import materialize
from callweave.sources.tables import read_table

PROJECT = "shop"
# Fixed values of the fixture rule: every 50th part gets a collection-like name.
FIXTURE_COLLECTION_NAMES = ["add", "get", "size", "clear"]
# Package whose classes play "system" classes for the typed front end.
SYSTEM_PLAY_PACKAGE = "shop.promo"


def fixture_methods(spark: SparkSession, sf_dir: str, project: str = PROJECT) -> DataFrame:
    """methods(project, package, class_name, class_fqn, file_ord, method_ord, method,
    method_fqn, loc, params)."""
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand", "p_size")
    key = F.col("p_partkey")
    package = F.concat(F.lit(project + "."), F.lower("p_type"))
    class_name = F.regexp_replace("p_brand", "#", "")
    coll = F.element_at(F.array(*[F.lit(x) for x in FIXTURE_COLLECTION_NAMES]),
                        (F.expr("p_partkey div 50") % 4 + 1).cast("int"))
    method = (F.when(key % 50 == 0, coll)
              .when(key % 2 == 0, F.concat(F.lit("m"), key.cast("string")))
              .otherwise(F.translate("p_name", " ", "_")))
    m = part.select(
        F.lit(project).alias("project"),
        package.alias("package"),
        class_name.alias("class_name"),
        N.full_class_name(package, class_name).alias("class_fqn"),
        key.alias("method_ord"),
        method.alias("method"),
        F.col("p_size").alias("loc"),
        (key % 7).cast("int").alias("params"),
        F.split("p_name", " ").getItem(0).alias("field"),
    )
    classes = m.select("project", "class_fqn").distinct()
    ords = with_group_position(classes, ["project"], ["class_fqn"], "file_ord")
    ords = ords.withColumn("file_ord", F.col("file_ord") + 1)
    return (m.join(ords, ["project", "class_fqn"])
            .withColumn("method_fqn", F.concat_ws(".", "class_fqn", "method")))


def fixture_classes(methods: DataFrame) -> DataFrame:
    """classes(project, package, class_name, class_fqn, file_ord, attr_count).

    Fields of a class: one per distinct first word of its parts' names.
    """
    return (methods.groupBy("project", "package", "class_name", "class_fqn", "file_ord")
            .agg(F.countDistinct("field").cast("int").alias("attr_count")))


def _following(order: str, value: str):
    """Batches in order -> (value, next, known, pid, place, order): pairs of neighbours with one order, both known.

    The first and last row of the task come along (``known`` false, ``place`` 0 and 1), to meet those of the
    neighbouring tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, names = TaskContext.get().partitionId(), ["value", "next", "known", "pid", "place", "order"]

        def rows(v, nx, o, place=None):
            n = len(v)
            at = pa.array([place] * n, pa.int32())
            return pa.RecordBatch.from_arrays([v.cast(pa.int64()), nx.cast(pa.int64()), pa.array([place is None] * n), pa.array([pid] * n, pa.int32()), at,
                                               o.cast(pa.int64())], names=names)

        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            o, v = batch.column(order), batch.column(value)
            if last is None:
                yield rows(v[:1], v[:1], o[:1], 0)
            else:
                o, v = pa.concat_arrays([last[0], o]), pa.concat_arrays([last[1], v])
            same = pc.fill_null(pc.equal(o[:-1], o[1:]), False)
            yield rows(v[:-1].filter(same), v[1:].filter(same), o[:-1].filter(same))
            last = o[-1:], v[-1:]
        if last is not None:
            yield rows(last[1], last[1], last[0], 1)
    return run


def consecutive_part_pairs(li: DataFrame) -> DataFrame:
    """Distinct (l_partkey, nx): part of a line and part of the next line of the same order.

    "Next line" without a window per order: the lines are range-sorted in a total order, so one huge order is
    split over many tasks, each task pairs the neighbours it sees, and the last line of a task is paired with
    the first one of the next task that has any (two rows a task)."""
    lines = li.select(*[F.col(c).cast("long").alias(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    found = lines.orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").select("l_orderkey", "l_partkey") \
        .mapInArrow(_following("l_orderkey", "l_partkey"), "value long, next long, known boolean, pid int, place int, `order` long")
    found = materialize(found, "line_pairs")
    ends = Window.orderBy("pid", "place")
    across = found.filter("NOT known").withColumn("_value", F.lead("value").over(ends)).withColumn("_order", F.lead("order").over(ends)) \
        .filter("place = 1 AND `order` = _order").select("value", F.col("_value").alias("next"))
    return found.filter("known").select("value", "next").unionByName(across) \
        .select(F.col("value").alias("l_partkey"), F.col("next").alias("nx")).distinct()


def fixture_invocations(spark: SparkSession, sf_dir: str, methods: DataFrame) -> DataFrame:
    """invocations(project, class_fqn, caller, file_ord, method_ord, callee_simple,
    callee_class, callee_true), distinct."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    pairs = consecutive_part_pairs(li)
    # until the rows are distinct a class is its number; the callers are joined last, so that equal rows
    # already meet and are not shuffled once more
    a = methods.select("project", "file_ord", "method_ord", F.col("method").alias("_method"))
    b = methods.select(F.col("project").alias("_bp"), F.col("method_ord").alias("_bord"),
                       F.col("method").alias("callee_simple"), F.col("file_ord").alias("_bfile"))
    called = pairs.join(b, pairs.nx == b._bord).select("l_partkey", "_bp", "_bfile", "callee_simple")
    rows = called.join(a, (called.l_partkey == a.method_ord) & (called._bp == a.project)) \
        .select("project", "file_ord", "method_ord", "_method", "_bfile", "callee_simple").distinct()
    # written: its size is known, so a few classes are broadcast and no row is shuffled with its names
    names = materialize(methods.select("project", "file_ord", "class_fqn").distinct(), "class_names")
    callees = names.select("project", F.col("file_ord").alias("_bfile"), F.col("class_fqn").alias("callee_class"))
    return rows.join(names, ["project", "file_ord"]).join(callees, ["project", "_bfile"]).select(
        "project", "class_fqn", F.concat_ws(".", "class_fqn", "_method").alias("caller"), "file_ord", "method_ord",
        "callee_simple", "callee_class", F.concat_ws(".", "callee_class", "callee_simple").alias("callee_true"))


def _system_play(c):
    return F.when(F.col(c).startswith(SYSTEM_PLAY_PACKAGE + "."), F.concat(F.lit("java."), F.col(c))) \
        .otherwise(F.col(c))


def fixture_typed_invocations(invocations: DataFrame) -> DataFrame:
    """Typed front end view: declaring classes known; package ``shop.promo`` plays the JDK."""
    return invocations.select(
        "project",
        _system_play("class_fqn").alias("class_fqn"),
        F.concat_ws(".", _system_play("class_fqn"), N.method_of("caller")).alias("caller"),
        _system_play("callee_class").alias("declaring_class"),
        F.col("callee_simple"),
    )


def fixture_typed_methods(methods: DataFrame) -> DataFrame:
    return methods.select("project", _system_play("class_fqn").alias("class_fqn"), "method",
                          F.concat_ws(".", _system_play("class_fqn"), F.col("method")).alias("method_fqn"))


# --- typed expressions and declared variables ------------------------------------------------
def _class_places(methods: DataFrame) -> DataFrame:
    """(project, class_fqn, class_name, file_ord, n): classes with their place and number."""
    classes = methods.select("project", "class_fqn", "class_name", "file_ord").distinct()
    return classes.join(classes.groupBy("project").agg(F.count(F.lit(1)).alias("n")), "project")


def fixture_members(methods: DataFrame) -> DataFrame:
    """members(project, class_fqn, kind, name, type_fqn): ``link0`` .. ``link3`` of most classes, methods for even
    numbers and fields for odd ones, each of another class's type; a few are of a system type."""
    c = _class_places(methods)
    k = F.col("k")
    m = c.withColumn("k", F.explode(F.array(*[F.lit(i) for i in range(4)]))).filter((F.col("file_ord") + k) % 7 != 0) \
        .withColumn("target", (F.col("file_ord") * 5 + k * 7 + 3) % F.col("n") + 1)
    t = c.select("project", F.col("file_ord").alias("target"), F.col("class_fqn").alias("_type"))
    return m.join(t, ["project", "target"]).select(
        "project", "class_fqn", F.when(k % 2 == 0, "call").otherwise("field").alias("kind"),
        F.concat(F.lit("link"), k.cast("string")).alias("name"),
        F.when((F.col("file_ord") + 2 * k) % 11 == 0, "java.util.List").otherwise(F.col("_type")).alias("type_fqn"))


def fixture_locals(methods: DataFrame) -> DataFrame:
    """variables(project, scope, name, type_fqn): one local ``v`` in three of four methods."""
    first = methods.groupBy("project", F.col("method_fqn").alias("scope")).agg(F.min("method_ord").alias("o")).filter("o % 4 <> 0")
    c = _class_places(methods)
    n = c.select("project", "n").distinct()
    typed = first.join(n, "project").withColumn("file_ord", F.col("o") * 17 % F.col("n") + 1)
    return typed.join(c.select("project", "file_ord", "class_fqn"), ["project", "file_ord"]) \
        .select("project", "scope", F.lit("v").alias("name"), F.col("class_fqn").alias("type_fqn"))


def fixture_expressions(invocations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(exprs, calls): a receiver chain of one to four expressions for every invocation.

    exprs(project, expr_id, receiver_id, kind, name, scope, class_fqn); calls(project, class_fqn, caller,
    callee_simple, declaring_class (null), expr_id) name the last expression of their chain."""
    h = F.col("method_ord") + F.length("callee_true")
    base = invocations.withColumn("h", h).withColumn("call", F.concat_ws("/", F.col("method_ord").cast("string"), "callee_true"))
    def key(i):
        return F.concat_ws("/", "call", i.cast("string"))
    steps = base.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("h") % 4)))
    i, root = F.col("i"), F.expr("(h div 4) % 3")
    call = (F.col("h") + i) % 2 == 0
    half = F.expr("((h + i) div 2) % 2")
    kind = F.when(i == 0, F.when(root == 0, "this").otherwise("name")).when(call, "call").otherwise("field")
    link = F.concat(F.lit("link"), F.when(call, half * 2).otherwise(half * 2 + 1).cast("string"))
    name = F.when(i == 0, F.when(root == 0, F.lit(None)).when(root == 1, "v").otherwise("link1")).otherwise(link)
    exprs = steps.select("project", key(i).alias("expr_id"), F.when(i > 0, key(i - 1)).alias("receiver_id"), kind.alias("kind"),
                         name.alias("name"), F.col("caller").alias("scope"), "class_fqn")
    calls = base.select("project", "class_fqn", "caller", "callee_simple", F.lit(None).cast("string").alias("declaring_class"),
                        key(F.col("h") % 4).alias("expr_id"))
    return exprs, calls


def fixture_variables(methods: DataFrame) -> DataFrame:
    """variables(project, file_ord, decl_ord, variable, type_name): a declaration per method; a third are called ``item``."""
    c = _class_places(methods)
    d = methods.join(c.select("project", "n").distinct(), "project") \
        .withColumn("target", F.col("method_ord") * 17 % F.col("n") + 1).select("project", "file_ord", "method_ord", "target")
    t = c.select("project", F.col("file_ord").alias("target"), "class_fqn", "class_name")
    o = F.col("method_ord")
    name = F.when(o % 3 == 0, "item").otherwise(F.concat(F.lit("v"), (o % 50).cast("string")))
    type_name = F.when(o % 13 == 0, "Missing").when(o % 5 == 0, F.col("class_fqn")).otherwise(F.col("class_name"))
    return d.join(t, ["project", "target"]).select("project", "file_ord", o.alias("decl_ord"), name.alias("variable"), type_name.alias("type_name"))


def fixture_receivers(invocations: DataFrame) -> DataFrame:
    """invocations with ``receiver``: ``item``, a numbered variable (some unknown) or a class's name in lower case."""
    o = F.length("callee_true") + F.col("method_ord")
    name = F.when(o % 3 == 0, "item").when(o % 3 == 1, F.concat(F.lit("v"), (F.col("method_ord") % 60).cast("string"))) \
        .otherwise(F.lower(N.short_name("callee_class")))
    return invocations.select("project", "caller", "file_ord", "callee_simple", name.alias("receiver")).distinct()
