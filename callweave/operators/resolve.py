"""Call resolution (G1-G12): from raw invocations to the call graph ``calls``.

Inputs
  methods     (project, class_fqn, method, method_fqn, file_ord, method_ord)
  invocations (project, caller, file_ord, method_ord, callee_simple[, declaring_class])
Output
  calls       (project, caller, callee) distinct

All steps are equi-joins against name dimensions built once by aggregation; the
tool's nested scans ("every class for every name") become one shuffle on the name.
A name called everywhere (a hot key) is handled by partial aggregation in the
dimension and by ``split_join`` (heavy names from a sketch, joined apart).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.functions import names as N
from callweave.functions.ranking import asof_join, split_join
from callweave.session import materialize


def _pos(file_ord="file_ord", method_ord="method_ord"):
    """Declaration / call position in file order (struct compare = lexicographic)."""
    return F.struct(F.col(file_ord).cast("long").alias("f"), F.col(method_ord).cast("long").alias("m"))


def method_index(methods: DataFrame) -> DataFrame:
    """G1: simple method name -> number of declaring classes and the first of them."""
    return (methods.groupBy("project", "method")
            .agg(F.countDistinct("class_fqn").alias("n_classes"),
                 F.min("class_fqn").alias("first_class"),
                 F.count(F.lit(1)).alias("n_declarations")))


def unique_names(methods: DataFrame, exclude_collection: bool = True) -> DataFrame:
    """Names declared by exactly one class: (project, method, unique_class)."""
    m = methods
    if exclude_collection:
        m = m.filter(~N.is_collection_method("method"))
    return (m.groupBy("project", "method")
            .agg(F.countDistinct("class_fqn").alias("_n"), F.min("class_fqn").alias("unique_class"))
            .filter(F.col("_n") == 1)
            .drop("_n"))


def resolve_declared(invocations: DataFrame) -> DataFrame:
    """Callee from the declaring class when the front end knows it, else null."""
    if "declaring_class" not in invocations.columns:
        invocations = invocations.withColumn("declaring_class", F.lit(None).cast("string"))
    dc = F.nullif(F.trim(F.col("declaring_class")), F.lit(""))
    return invocations.withColumn("callee_declared", F.concat_ws(".", dc, F.col("callee_simple"))) \
        .withColumn("callee_declared", F.when(dc.isNotNull(), F.col("callee_declared")))


def resolve_global(invocations: DataFrame, methods: DataFrame) -> DataFrame:
    """G4+G5 (order-free): declared type, else the only declaring class (not a
    collection name), else the simple name. Returns distinct (project, caller, callee)."""
    inv = resolve_declared(invocations)
    u = unique_names(methods).withColumnRenamed("method", "callee_simple")
    out = split_join(inv, u, ["project", "callee_simple"])
    # concat_ws skips nulls: guard so an unknown class does not yield the bare name
    callee = F.coalesce(F.col("callee_declared"),
                        F.when(F.col("unique_class").isNotNull(),
                               F.concat_ws(".", F.col("unique_class"), F.col("callee_simple"))),
                        F.col("callee_simple"))
    return out.select("project", "caller", callee.alias("callee")).distinct()


def name_first_positions(methods: DataFrame) -> DataFrame:
    """Per name: first declaration position p1 with its class c1, and p2 = first
    position of a declaration in another class (null when there is none).

    Names grow with the input but compress well: they are merged, else they are broadcast long after they are too
    many for the driver."""
    decl = methods.select("project", "method", "class_fqn", _pos().alias("p"))
    first = (decl.groupBy("project", "method")
             .agg(F.min("p").alias("p1"), F.min_by("class_fqn", "p").alias("c1")))
    second = (decl.join(first.hint("merge"), ["project", "method"])
              .filter(F.col("class_fqn") != F.col("c1"))
              .groupBy("project", "method").agg(F.min("p").alias("p2")))
    return first.join(second.hint("merge"), ["project", "method"], "left")


def resolve_sequential(invocations: DataFrame, methods: DataFrame) -> DataFrame:
    """G3 then G4: pass 1 infers a name when exactly one class declared it *so far*
    in file order (no collection filter); pass 2 resolves what is left globally."""
    inv = resolve_declared(invocations).withColumn("_p", _pos())
    firsts = name_first_positions(methods).withColumnRenamed("method", "callee_simple")
    u = unique_names(methods).withColumnRenamed("method", "callee_simple")
    # one row per name with both dimensions, so the calls are joined once; merged as in name_first_positions
    dims = firsts.join(u.hint("merge"), ["project", "callee_simple"], "left").hint("merge")
    j = split_join(inv, dims, ["project", "callee_simple"])
    inferred = F.when((F.col("p1") <= F.col("_p")) & (F.col("p2").isNull() | (F.col("_p") < F.col("p2"))),
                      F.concat_ws(".", F.col("c1"), F.col("callee_simple")))
    glob = F.when(F.col("unique_class").isNotNull(),
                  F.concat_ws(".", F.col("unique_class"), F.col("callee_simple")))
    callee = F.coalesce(F.col("callee_declared"), inferred, glob, F.col("callee_simple"))
    return j.select("project", "caller", callee.alias("callee")).distinct()


def unresolved_calls(calls: DataFrame) -> DataFrame:
    """Edges whose callee stayed a simple name."""
    return calls.filter(N.is_simple_name("callee"))


def resolve_super(super_invocations: DataFrame) -> DataFrame:
    """Super calls resolve through the declaring class or become ``super.m``."""
    inv = resolve_declared(super_invocations)
    callee = F.coalesce(F.col("callee_declared"), F.concat(F.lit("super."), F.col("callee_simple")))
    return inv.select("project", "caller", callee.alias("callee")).distinct()


def class_short_names(classes: DataFrame) -> DataFrame:
    """(project, short, class_fqn = first class with that short name)."""
    return (classes.select("project", "class_fqn")
            .groupBy("project", N.short_name("class_fqn").alias("short"))
            .agg(F.min("class_fqn").alias("class_fqn")))


def resolve_type_name(types: DataFrame, classes: DataFrame, col: str = "type_name",
                      out: str = "type_fqn", methods: DataFrame | None = None) -> DataFrame:
    """Dotted names as they are, else the class with that short name, else (with ``methods``) the
    declaring class of any method that has it, else null."""
    shorts = class_short_names(classes).withColumnRenamed("class_fqn", "_by_short")
    if methods is not None:
        index = class_short_names(methods).withColumnRenamed("class_fqn", "_by_index")
        shorts = shorts.join(index, ["project", "short"], "full") \
            .select("project", "short", F.coalesce("_by_short", "_by_index").alias("_by_short"))
    j = split_join(types, shorts.withColumnRenamed("short", col), ["project", col])
    return j.withColumn(out, F.when(F.instr(F.col(col), ".") > 0, F.col(col)).otherwise(F.col("_by_short"))) \
        .drop("_by_short")


def resolve_local_calls(local_calls: DataFrame, classes: DataFrame, entry_class_fqn: str | None = None) -> DataFrame:
    """Calls on local variables of the entry class: ``Entry.method -> Type.called``.

    local_calls(project, entry_fqn, method, variable, method_name, type_name)."""
    typed = resolve_type_name(local_calls, classes)
    entry = F.lit(entry_class_fqn) if entry_class_fqn else F.col("entry_fqn")
    return (typed.filter(F.col("type_fqn").isNotNull())
            .select("project",
                    F.concat_ws(".", entry, F.col("method")).alias("caller"),
                    F.concat_ws(".", F.col("type_fqn"), F.col("method_name")).alias("callee"))
            .distinct())


def resolve_by_receiver(invocations: DataFrame, classes: DataFrame, variables: DataFrame | None = None,
                        methods: DataFrame | None = None) -> DataFrame:
    """G9 (optional stage): callee from the receiver's name.

    With ``variables`` (project, file_ord, decl_ord, variable, type_name) the receiver has the type of the
    last declaration of that variable in the call's file or an earlier one, where that type is known
    (G7).  Else a class counts whose short name is the variable, case-insensitively."""
    inv = invocations
    if variables is None:
        inv = inv.withColumn("type_name", F.lit(None).cast("string"))
    else:
        place = F.struct(F.col("file_ord").cast("long").alias("f"), F.col("decl_ord").cast("long").alias("d"))
        end_of_file = F.struct(F.col("file_ord").cast("long").alias("f"), F.lit((1 << 63) - 1).alias("d"))
        inv = asof_join(inv, variables.withColumnRenamed("variable", "receiver"), ["project", "receiver"], end_of_file,
                        place, ["type_name"])
        # written: a split join reads its rows three times
        inv = materialize(inv, "receivers")
    typed = resolve_type_name(inv, classes, methods=methods).withColumn("_lc", F.lower("receiver"))
    typed = typed.select("project", "caller", "receiver", "callee_simple", "type_fqn", "_lc")
    if variables is not None:
        typed = materialize(typed, "receiver_types")
    shorts = (classes.groupBy("project", F.lower(N.short_name("class_fqn")).alias("_lc"))
              .agg(F.min("class_fqn").alias("_rc")))
    j = split_join(typed, shorts, ["project", "_lc"])
    owner = F.coalesce("type_fqn", "_rc")
    return j.select("project", "caller", "receiver", "callee_simple",
                    F.when(owner.isNotNull(), F.concat_ws(".", owner, "callee_simple")).alias("callee_inferred"))


def call_graph(*edge_sets: DataFrame) -> DataFrame:
    """Union of resolved edge sets, overloads merged (distinct)."""
    out = edge_sets[0].select("project", "caller", "callee")
    for e in edge_sets[1:]:
        out = out.unionByName(e.select("project", "caller", "callee"))
    return out.distinct()


def call_graph_text(methods: DataFrame, calls: DataFrame) -> DataFrame:
    """The ``caller --> [callees]`` listing as rows (project, caller, item_no, text).

    Item 0 is ``caller -->`` (every method, callers without calls included), items
    1..k the callees in name order. A caller with a huge callee set is spread over
    many rows and ranked by the range-sorted index, never gathered into one line."""
    from callweave.functions.ranking import with_group_position
    nodes = (methods.select("project", F.col("method_fqn").alias("caller"))
             .unionByName(calls.select("project", "caller")).distinct())
    head = nodes.select("project", "caller", F.lit(0).cast("long").alias("item_no"),
                        F.concat(F.col("caller"), F.lit(" -->")).alias("text"))
    items = with_group_position(calls.select("project", "caller", "callee"), ["project", "caller"], ["callee"], "_i")
    items = items.select("project", "caller", (F.col("_i") + 1).alias("item_no"), F.col("callee").alias("text"))
    return head.unionByName(items)


def call_graph_size(methods: DataFrame, calls: DataFrame) -> DataFrame:
    """Node and edge totals (nodes = declared methods plus extra callers)."""
    nodes = methods.select("project", F.col("method_fqn").alias("caller")) \
        .unionByName(calls.select("project", "caller")).distinct()
    n = nodes.groupBy("project").agg(F.count(F.lit(1)).alias("nodes"))
    e = calls.groupBy("project").agg(F.count(F.lit(1)).alias("edges"))
    return n.join(e, "project", "left").select("project", "nodes", F.coalesce("edges", F.lit(0)).alias("edges"))
