"""Code metrics (M0-M16) over the ``classes`` and ``methods`` tables.

Per-project totals are single grouped aggregates; "top 10 %" lists use the
range-sorted position inside the project (``top_percent``), so a project holding
a third of all methods is still ranked by many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.functions.ranking import top_percent, with_group_position
from callweave.session import materialize

TOP_PERCENT = 0.1
DEFAULT_X = 3  # both entry points ask for "classes with more than 3 methods"


def class_rollup(classes: DataFrame, methods: DataFrame) -> DataFrame:
    """M0: per class: method count and attribute count (classes without methods too)."""
    mc = methods.groupBy("project", "class_fqn").agg(F.count(F.lit(1)).alias("method_count"))
    return (classes.join(mc, ["project", "class_fqn"], "left")
            .select("project", "package", "class_fqn", F.coalesce("method_count", F.lit(0)).alias("method_count"),
                    F.col("attr_count").cast("long").alias("attr_count")))


def project_totals(classes: DataFrame, methods: DataFrame) -> DataFrame:
    """M1-M4, M13 and the attribute total."""
    c = classes.groupBy("project").agg(F.count(F.lit(1)).alias("n_classes"),
                                       F.countDistinct("package").alias("n_packages"),
                                       F.sum("attr_count").cast("long").alias("n_attributes"))
    m = methods.groupBy("project").agg(F.count(F.lit(1)).alias("n_methods"),
                                       F.sum("loc").cast("long").alias("total_loc"),
                                       F.max("params").alias("max_params"))
    return c.join(m, "project", "left").select(
        "project", "n_classes", F.coalesce("total_loc", F.lit(0)).cast("long").alias("total_loc"),
        F.coalesce("n_methods", F.lit(0)).alias("n_methods"), "n_packages", "n_attributes",
        F.coalesce("max_params", F.lit(0)).cast("int").alias("max_params"))


def project_averages(totals: DataFrame) -> DataFrame:
    """M5-M7, 0.0 when the divisor is 0."""
    def ratio(a, b):
        return F.when(F.col(b) == 0, F.lit(0.0)).otherwise(F.col(a) / F.col(b))
    return totals.select("project", ratio("n_methods", "n_classes").alias("methods_per_class"),
                         ratio("total_loc", "n_methods").alias("loc_per_method"),
                         ratio("n_attributes", "n_classes").alias("attrs_per_class"))


def top_classes_by(rollup: DataFrame, col: str, percent: float = TOP_PERCENT) -> DataFrame:
    """M8/M9: first max(1, ceil(n p)) classes by ``col`` descending (ties by name)."""
    t = top_percent(rollup, ["project"], [F.col(col).desc(), F.col("class_fqn")], percent)
    return t.select("project", "rank", "class_fqn", col)


def top_classes_both(rollup: DataFrame, percent: float = TOP_PERCENT) -> DataFrame:
    """Classes in both top lists."""
    a = top_classes_by(rollup, "method_count", percent).select("project", "class_fqn")
    b = top_classes_by(rollup, "attr_count", percent).select("project", "class_fqn")
    return a.intersect(b)


def classes_over_x(rollup: DataFrame, x: int = DEFAULT_X) -> DataFrame:
    """M11."""
    return rollup.filter(F.col("method_count") > x).select("project", "class_fqn", "method_count")


def top_methods_by_loc(methods: DataFrame, percent: float = TOP_PERCENT) -> DataFrame:
    """M12 + M14: top methods by LOC over the whole project, with display text."""
    t = top_percent(methods, ["project"], [F.col("loc").desc(), F.col("method_fqn"), F.col("method_ord")], percent)
    return t.select("project", "rank", "method_fqn", "loc", "params",
                    F.format_string("%s [LOC=%d, params=%d]", F.col("method"), F.col("loc"), F.col("params"))
                    .alias("display"))


# Labels of the statistics report, in its order.
LABELS = {
    "classes": "Nombre de classes",
    "loc": "Nombre de lignes de code",
    "methods": "Nombre total de méthodes",
    "packages": "Nombre total de packages",
    "methods_per_class": "Moyenne méthodes par classe",
    "loc_per_method": "Moyenne LOC par méthode",
    "attrs_per_class": "Moyenne attributs par classe",
    "top_methods": "Top 10% classes (most methods)",
    "top_attributes": "Top 10% classes (most attributes)",
    "both": "Classes in both groups",
    "top_loc": "Top 10% methods by LOC",
    "max_params": "Max number of parameters in any method",
}


def statistics_report(classes: DataFrame, methods: DataFrame, x: int = DEFAULT_X,
                      percent: float = TOP_PERCENT) -> DataFrame:
    """The statistics as report rows (project, line_no, item_no, text).

    Scalar lines have item_no 0; list lines (8, 9, 10, 11, 12) put their header at
    item 0 and one row per listed name after it, so no line is built from an
    unbounded list."""
    tot = project_totals(classes, methods)
    avg = project_averages(tot)
    t = tot.join(avg, "project")

    def line(no, label, value):
        return t.select("project", F.lit(no).alias("line_no"), F.lit(0).cast("long").alias("item_no"),
                        F.concat(F.lit(f"{no}. {label}: "), value.cast("string")).alias("text"))

    rows = [line(1, LABELS["classes"], F.col("n_classes")),
            line(2, LABELS["loc"], F.col("total_loc")),
            line(3, LABELS["methods"], F.col("n_methods")),
            line(4, LABELS["packages"], F.col("n_packages")),
            line(5, LABELS["methods_per_class"], F.col("methods_per_class")),
            line(6, LABELS["loc_per_method"], F.col("loc_per_method")),
            line(7, LABELS["attrs_per_class"], F.col("attrs_per_class")),
            line(13, LABELS["max_params"], F.col("max_params"))]
    roll = materialize(class_rollup(classes, methods), "rollup")
    # one ranking per order; each top list is a prefix of it
    by_m = with_group_position(roll, ["project"], [F.col("method_count").desc(), F.col("class_fqn")], "_p", "_n")
    by_a = with_group_position(roll, ["project"], [F.col("attr_count").desc(), F.col("class_fqn")], "_p", "_n")
    by_loc = with_group_position(methods, ["project"],
                                 [F.col("loc").desc(), F.col("method_fqn"), F.col("method_ord")], "_p", "_n")

    def prefix(df):
        keep = F.greatest(F.lit(1), F.ceil(F.col("_n") * F.lit(percent)))
        return df.filter(F.col("_p") < keep).withColumn("rank", F.col("_p") + 1)

    top_m, top_a = prefix(by_m), prefix(by_a)

    def listing(no, header, df, text_col, order_col):
        head = t.select("project", F.lit(no).alias("line_no"), F.lit(0).cast("long").alias("item_no"),
                        F.lit(f"{no}. {header}:").alias("text"))
        items = df.select("project", F.lit(no).alias("line_no"), F.col(order_col).cast("long").alias("item_no"),
                          F.col(text_col).alias("text"))
        return head.unionByName(items)

    rows.append(listing(8, LABELS["top_methods"], top_m, "class_fqn", "rank"))
    rows.append(listing(9, LABELS["top_attributes"], top_a, "class_fqn", "rank"))
    both = top_m.join(top_a.select("project", "class_fqn"), ["project", "class_fqn"], "left_semi")
    rows.append(listing(10, LABELS["both"], both, "class_fqn", "rank"))
    over = by_m.filter(F.col("method_count") > x).withColumn("_r", F.col("_p") + 1)
    rows.append(listing(11, f"Classes with more than {x} methods", over, "class_fqn", "_r"))
    loc_top = prefix(by_loc).withColumn(
        "display", F.format_string("%s [LOC=%d, params=%d]", F.col("method"), F.col("loc"), F.col("params")))
    rows.append(listing(12, LABELS["top_loc"], loc_top, "display", "rank"))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
