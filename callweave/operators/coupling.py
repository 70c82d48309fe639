"""Class coupling.

``coupling`` rows: (project, a, b, n_calls[, weight]).
Front end 1 is undirected (a < b); front end 2 is directed (a = caller class).

Each count is one grouped ``countDistinct`` (expand + partial aggregation, so a
hub class does not ship its raw rows through one task); totals are one row per
project and are joined back, not computed by an un-partitioned window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.functions import names as N
from callweave.functions.ranking import spread_join


def caller_class_dim(nodes: DataFrame) -> DataFrame:
    """C1 lookup dimension: lower(short class name) -> first caller class with it.

    nodes(project, caller): every method of the call graph (callers without calls too)."""
    cls = nodes.select("project", N.class_of_method("caller").alias("_cls")).filter(F.col("_cls").isNotNull())
    return (cls.groupBy("project", F.lower(N.short_name("_cls")).alias("_lshort"))
            .agg(F.min("_cls").alias("_match")))


def with_class_of(df: DataFrame, col: str, out: str, dim: DataFrame) -> DataFrame:
    """Class of a method name; an undotted class is matched case-insensitively to a
    caller class's short name."""
    # Only undotted classes (rare: ``super``, bare type names) need the lookup, so the
    # join sees just those rows; dotted rows pass by without a shuffle.
    raw = df.withColumn("_raw", N.class_of_method(col))
    simple = F.coalesce(N.is_simple_name("_raw"), F.lit(False))
    d = dim.select(F.col("project").alias("_dp"), "_lshort", "_match")
    looked = (raw.filter(simple)
              .join(d, (F.col("project") == F.col("_dp")) & (F.lower("_raw") == F.col("_lshort")), "left")
              .withColumn(out, F.coalesce(F.col("_match"), F.col("_raw")))
              .drop("_raw", "_dp", "_lshort", "_match"))
    passed = raw.filter(~simple).withColumn(out, F.col("_raw")).drop("_raw")
    return passed.unionByName(looked)


def detected_packages(calls: DataFrame, nodes: DataFrame) -> DataFrame:
    """Packages of every caller and callee class."""
    dim = caller_class_dim(nodes)
    callers = with_class_of(nodes.select("project", "caller"), "caller", "cls", dim).select("project", "cls")
    callees = with_class_of(calls.select("project", "callee"), "callee", "cls", dim).select("project", "cls")
    pk = callers.unionByName(callees).select("project", N.package_of("cls").alias("package"))
    return pk.filter(F.col("package").isNotNull() & (F.col("package") != "")).distinct()


def project_class_filter(df: DataFrame, col: str, packages: DataFrame | None = None) -> DataFrame:
    """Keep rows whose class belongs to the project.

    Against the packages detected from the same graph this is "has a package"; with a
    user-given package list it is a prefix semi-join (equal, parent or child)."""
    pk = N.package_of(col)
    if packages is None:
        return df.filter(pk.isNotNull())
    # classes of the graph are judged once each; a class qualifies when its package, one of the
    # package's ancestors, or one of a listed package's ancestors meets the other side by equality
    def ancestors(df: DataFrame, name: str) -> DataFrame:
        parts = F.split(F.col(name), "[.]")
        return df.withColumn("_up", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(
            F.slice(parts, F.lit(1), n), "."))))

    own = df.select("project", F.col(col).alias("_cls"), pk.alias("_pk")).distinct().filter(F.col("_pk").isNotNull())
    listed = packages.select("project", F.col("package").alias("_listed")).distinct()
    below = ancestors(own, "_pk").join(listed, (F.col("_listed") == F.col("_up")) & (own["project"] == listed["project"]),
                                       "left_semi").select("project", "_cls")
    above = own.join(ancestors(listed, "_listed").select("project", F.col("_up").alias("_pk")).distinct(),
                     ["project", "_pk"], "left_semi").select("project", "_cls")
    keep = below.unionByName(above).distinct().withColumnRenamed("_cls", col)
    return df.join(keep, ["project", col], "left_semi").select(*df.columns)


def coupling_undirected(calls: DataFrame, nodes: DataFrame, packages: DataFrame | None = None) -> DataFrame:
    """C4: distinct callee methods per unordered pair of different project classes."""
    dim = caller_class_dim(nodes)
    e = with_class_of(calls, "caller", "cc", dim)
    e = with_class_of(e, "callee", "ce", dim)
    e = project_class_filter(e.filter(F.col("ce").isNotNull()), "cc", packages)
    e = project_class_filter(e, "ce", packages).filter(F.col("cc") != F.col("ce"))
    a, b = N.canonical_pair("cc", "ce")
    return (e.groupBy("project", a.alias("a"), b.alias("b"))
            .agg(F.countDistinct("callee").alias("n_calls")))


def coupling_directed(typed_calls: DataFrame) -> DataFrame:
    """Distinct (caller class, callee class, method name), system classes removed."""
    e = typed_calls.select("project", N.class_of_method("caller").alias("a"),
                           N.class_of_method("callee").alias("b"), N.method_of("callee").alias("m"))
    e = e.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))
                 & ~N.is_system_class("a") & ~N.is_system_class("b"))
    return e.groupBy("project", "a", "b").agg(F.countDistinct("m").alias("n_calls"))


def coupling_total(coupling: DataFrame) -> DataFrame:
    """One row per project."""
    return coupling.groupBy("project").agg(F.sum("n_calls").cast("long").alias("total"))


def coupling_weights(coupling: DataFrame) -> DataFrame:
    """weight = n_calls / total of the project (0.0 when the total is 0)."""
    t = coupling_total(coupling)
    return (spread_join(coupling, t, ["project"])
            .withColumn("weight", F.when(F.col("total") > 0, F.col("n_calls") / F.col("total"))
                        .otherwise(F.lit(0.0)))
            .drop("total"))


def pair_lookup(pairs: DataFrame, weights: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Weight of a class pair in either direction, 0.0 when absent.

    ``weights`` must hold one row per unordered pair (fold a directed matrix first)."""
    lo, hi = N.canonical_pair(x, y)
    w = weights.select(F.col("project").alias("_wp"), F.col("a").alias("_wa"), F.col("b").alias("_wb"),
                       F.col("weight").alias("_w"))
    j = pairs.join(w, (F.col("project") == F.col("_wp")) & (lo == F.col("_wa")) & (hi == F.col("_wb")), "left")
    return j.withColumn("weight", F.coalesce(F.col("_w"), F.lit(0.0))).drop("_wp", "_wa", "_wb", "_w")


def coupled_classes(coupling: DataFrame) -> DataFrame:
    """Classes present in the matrix (sources and targets)."""
    return (coupling.select("project", F.col("a").alias("class_fqn"))
            .unionByName(coupling.select("project", F.col("b").alias("class_fqn")))
            .distinct())


def fold_directed(coupling: DataFrame) -> DataFrame:
    """H0: one count per unordered pair; the smaller->larger direction wins when both exist."""
    a, b = N.canonical_pair("a", "b")
    return (coupling.groupBy("project", a.alias("a"), b.alias("b"))
            .agg(F.coalesce(F.max(F.when(F.col("a") < F.col("b"), F.col("n_calls"))),
                            F.max("n_calls")).alias("n_calls")))
