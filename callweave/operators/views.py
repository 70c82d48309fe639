"""Ranked views, graph views and summaries over a coupling table.

``weights``: (project, a, b, n_calls, weight). Within a project ``weight`` is
``n_calls / total``, so ordering by ``n_calls`` is the same order without float
ties; ties are broken by names so every list is deterministic.

Top-k lists use a salted two-stage window per project (a project with a third of
all pairs is cut into buckets first); full rankings use the range-sorted global
index, never a single-partition window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.functions import names as N
from callweave.functions.ranking import top_k_per_group, with_group_position
from callweave.operators.coupling import coupled_classes, coupling_total

DEFAULT_MIN_WEIGHT = 0.001
DEFAULT_MAX_NODES = 50

def _by_weight():
    return [F.col("n_calls").desc(), F.col("a"), F.col("b")]


def top_pairs(weights: DataFrame, k: int) -> DataFrame:
    """V1 (k=20), V3 (k=10), V5 (k=3): strongest pairs with 1-based rank."""
    return top_k_per_group(weights, ["project"], _by_weight(), k)


def top20_pairs(weights: DataFrame) -> DataFrame:
    return top_pairs(weights, 20).select("project", "rank", "a", "b", "n_calls", "weight")


def top10_pairs(weights: DataFrame) -> DataFrame:
    return top_pairs(weights, 10).select("project", "rank", N.short_name("a").alias("a_short"),
                                         N.short_name("b").alias("b_short"), "n_calls", "weight")


def top3_pairs(weights: DataFrame) -> DataFrame:
    return top_pairs(weights, 3).select("project", "rank", N.short_name("a").alias("a_short"),
                                        N.short_name("b").alias("b_short"), "n_calls",
                                        (F.col("weight") * 100).alias("percentage"))


def ranked_pairs(weights: DataFrame) -> DataFrame:
    """V2: every pair with its rank in the project."""
    r = with_group_position(weights, ["project"], _by_weight(), "_pos")
    return r.select("project", (F.col("_pos") + 1).alias("rank"), "a", "b", "n_calls", "weight")


def top5_directed(weights: DataFrame) -> DataFrame:
    """V4 list: five strongest directed pairs by count."""
    return top_pairs(weights, 5).select("project", "rank", "a", "b", "n_calls", "weight")


def directed_density(weights: DataFrame) -> DataFrame:
    """V4 figures: classes (sources only), total and total / (n (n-1)); null for n < 2."""
    g = weights.groupBy("project").agg(F.countDistinct("a").alias("n_classes"),
                                       F.sum("n_calls").cast("long").alias("total"))
    n = F.col("n_classes")
    return g.withColumn("mean_coupling",
                        F.when(n >= 2, F.col("total") / (n * (n - 1)).cast("double")))


def edges_over_threshold(weights: DataFrame, min_weight: float = DEFAULT_MIN_WEIGHT) -> DataFrame:
    """V6."""
    return weights.filter(F.col("weight") >= F.lit(min_weight))


def threshold_summary(weights: DataFrame, min_weight: float = DEFAULT_MIN_WEIGHT) -> DataFrame:
    """V7: edge count and total weight at or over the threshold (per project)."""
    t = coupling_total(weights)
    kept = edges_over_threshold(weights, min_weight).groupBy("project").agg(
        F.count(F.lit(1)).alias("edges"), F.sum("n_calls").cast("long").alias("_n"))
    j = t.join(kept, "project", "left")
    return j.select("project", F.lit(float(min_weight)).alias("min_weight"),
                    F.coalesce("edges", F.lit(0)).cast("long").alias("edges"),
                    F.when(F.col("total") > 0, F.coalesce("_n", F.lit(0)) / F.col("total"))
                    .otherwise(F.lit(0.0)).alias("total_weight"), "total")


def coupling_stats(weights: DataFrame) -> DataFrame:
    """V8: mean and max weight, classes involved (0.0 when empty)."""
    g = weights.groupBy("project").agg(F.count(F.lit(1)).alias("pairs"),
                                       F.sum("n_calls").cast("long").alias("total"),
                                       F.max("n_calls").alias("_max"))
    cls = coupled_classes(weights).groupBy("project").agg(F.count(F.lit(1)).alias("classes"))
    return g.join(cls, "project", "left").select(
        "project", "pairs",
        (F.col("total") / (F.col("pairs") * F.col("total")).cast("double")).alias("mean_weight"),
        (F.col("_max") / F.col("total")).alias("max_weight"),
        F.coalesce("classes", F.lit(0)).alias("classes"))


def package_coupling(weights: DataFrame) -> DataFrame:
    """V9: calls and connections per group package; a pair inside one package counts once."""
    pk = F.explode(F.array_distinct(F.array(N.group_package("a"), N.group_package("b"))))
    return (weights.select("project", pk.alias("package"), "n_calls")
            .groupBy("project", "package")
            .agg(F.sum("n_calls").cast("long").alias("calls"), F.count(F.lit(1)).alias("connections")))


def node_degree(weights: DataFrame) -> DataFrame:
    """Distinct out-neighbours plus in-neighbours."""
    return (weights.select("project", F.explode(F.array("a", "b")).alias("class_fqn"))
            .groupBy("project", "class_fqn").agg(F.count(F.lit(1)).alias("degree")))


def top_degree_nodes(weights: DataFrame, max_nodes: int = DEFAULT_MAX_NODES) -> DataFrame:
    """Most connected classes."""
    return top_k_per_group(node_degree(weights), ["project"],
                           [F.col("degree").desc(), F.col("class_fqn")], max_nodes)


def dot_nodes(weights: DataFrame, max_nodes: int = DEFAULT_MAX_NODES) -> DataFrame:
    """The alphabetically first ``max_nodes`` classes, with short label."""
    t = top_k_per_group(coupled_classes(weights), ["project"], [F.col("class_fqn")], max_nodes)
    return t.select("project", "rank", "class_fqn", N.short_name("class_fqn").alias("label"))


def induced_subgraph(weights: DataFrame, nodes: DataFrame,
                     min_weight: float = DEFAULT_MIN_WEIGHT) -> DataFrame:
    """Both ends selected and weight over the threshold.

    ``nodes`` is a display selection per project; with many projects it is no small table, so
    how it is joined is left to the runtime sizes."""
    sel = nodes.select("project", "class_fqn").distinct()
    e = edges_over_threshold(weights, min_weight)
    e = e.join(sel.withColumnRenamed("class_fqn", "a"), ["project", "a"], "left_semi")
    return e.join(sel.withColumnRenamed("class_fqn", "b"), ["project", "b"], "left_semi")


def edge_style(weights: DataFrame) -> DataFrame:
    """Edge label and opacity."""
    return weights.select("project", "a", "b", "n_calls", "weight",
                          F.format_string("%.3f (%d)", F.col("weight"), F.col("n_calls")).alias("label"),
                          F.least(F.col("weight") * 100, F.lit(1.0)).alias("opacity"))


def coupling_csv(weights: DataFrame, min_weight: float = DEFAULT_MIN_WEIGHT) -> DataFrame:
    """V15/K3 rows: Source, Target, Weight, Count, Percentage (sorted by the sink)."""
    return edges_over_threshold(weights, min_weight).select(
        "project", F.col("a").alias("source"), F.col("b").alias("target"), "weight",
        F.col("n_calls").alias("count"), (F.col("weight") * 100).alias("percentage"))


# Lines of the coupling summary, in their order.
SUMMARY = {
    "packages": "Packages détectés :",
    "total": "Total inter-class calls = ",
    "ranked": "Couplages par ordre d'importance :",
    "pair": "%2d) %s -- %s : %.4f (%d appels)",
    "details": "=== STATISTIQUES DÉTAILLÉES ===",
    "mean": "Couplage moyen : %.4f",
    "max": "Couplage maximum : %.4f",
    "involved": "Classes impliquées : %d",
    "top3": "=== TOP 3 COUPLAGES LES PLUS FORTS ===",
    "top3_pair": "%d. %s → %s : %.2f%% (%d appels)",
    "by_package": "=== ANALYSE PAR PACKAGE ===",
    "package": "Package %s : %d appels (%d connexions)",
}


def coupling_summary(weights: DataFrame, packages: DataFrame, label: str = "JDT") -> DataFrame:
    """The coupling text summary as rows (project, section, line_no, text).

    Lists (packages, ranked pairs, package roll-up) give one row per item, so no
    single line is built from an unbounded list; ``line_no`` orders rows in a section."""
    tot = coupling_total(weights)
    stats = coupling_stats(weights)

    def rows(df, section, line_no, text):
        return df.select("project", F.lit(section).alias("section"), F.lit(line_no).cast("long").alias("line_no"),
                         text.alias("text"))

    parts = [rows(tot, 0, 0, F.lit(f"=== RÉSUMÉ COUPLAGE ENTRE CLASSES ({label}) ===")),
             rows(tot, 1, 0, F.lit(SUMMARY["packages"])),
             with_group_position(packages, ["project"], ["package"], "_pos").select(
                 "project", F.lit(1).alias("section"), (F.col("_pos") + 1).alias("line_no"),
                 F.col("package").alias("text")),
             rows(tot, 2, 0, F.concat(F.lit(SUMMARY["total"]), F.col("total").cast("string"))),
             rows(tot, 3, 0, F.lit(SUMMARY["ranked"]))]
    ranked = ranked_pairs(weights)
    parts.append(ranked.select("project", F.lit(3).alias("section"), F.col("rank").alias("line_no"),
                               F.format_string(SUMMARY["pair"], F.col("rank"),
                                               N.short_name("a"), N.short_name("b"), F.col("weight"),
                                               F.col("n_calls")).alias("text")))
    parts += [rows(stats, 4, 0, F.lit(SUMMARY["details"])),
              rows(stats, 4, 1, F.format_string(SUMMARY["mean"], F.col("mean_weight"))),
              rows(stats, 4, 2, F.format_string(SUMMARY["max"], F.col("max_weight"))),
              rows(stats, 4, 3, F.format_string(SUMMARY["involved"], F.col("classes"))),
              rows(tot, 5, 0, F.lit(SUMMARY["top3"]))]
    parts.append(top3_pairs(weights).select(
        "project", F.lit(5).alias("section"), F.col("rank").alias("line_no"),
        F.format_string(SUMMARY["top3_pair"], F.col("rank"), F.col("a_short"), F.col("b_short"),
                        F.col("percentage"), F.col("n_calls")).alias("text")))
    parts.append(rows(tot, 6, 0, F.lit(SUMMARY["by_package"])))
    parts.append(with_group_position(package_coupling(weights), ["project"], ["package"], "_pos").select(
        "project", F.lit(6).alias("section"), (F.col("_pos") + 1).alias("line_no"),
        F.format_string(SUMMARY["package"], F.col("package"), F.col("calls"),
                        F.col("connections")).alias("text")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
