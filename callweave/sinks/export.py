"""Sinks (K1-K6): DOT, JSON, CSV and text outputs of the coupling graph and modules.

Every sink is a DataFrame of output rows plus a writer. Line-oriented formats carry
an ``ord`` column and are written sorted, one part per range of ``ord``; only the
display-sized DOT graph (at most ``max_nodes`` nodes) is coalesced to one file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from callweave.functions import names as N
from callweave.functions.ranking import ordered_cells, with_group_position
from callweave.operators import views as V
from callweave.operators.coupling import coupled_classes, coupling_total
from callweave.session import materialize

# Fixed values of the DOT header.
DOT_HEADER = ["digraph CouplingGraph {", "  rankdir=LR;",
              "  node [shape=box, style=filled, fillcolor=lightblue];", "  edge [fontsize=10];", ""]


# Fixed values of the DOT trailer.
DOT_EDGES, DOT_CALLS, DOT_END = "  // Total edges: %d", "  // Total inter-class calls: %d", "}"


def dot_lines(weights: DataFrame, min_weight: float = V.DEFAULT_MIN_WEIGHT,
              max_nodes: int = V.DEFAULT_MAX_NODES) -> DataFrame:
    """K1: (project, section, ord, line) of the DOT digraph: 0 header, 1 nodes, 2 edges, 3 trailer."""
    projects = coupling_total(weights)

    def lines(df, section, ord_, line):
        return df.select("project", F.lit(section).alias("section"), F.col(ord_).cast("long").alias("ord")
                         if isinstance(ord_, str) else F.lit(ord_).cast("long").alias("ord"), line.alias("line"))

    parts = [lines(projects, 0, i, F.lit(t)) for i, t in enumerate(DOT_HEADER)]
    nodes = V.dot_nodes(weights, max_nodes)
    parts.append(lines(nodes, 1, "rank", F.format_string('  "%s" [label="%s"];', F.col("class_fqn"), F.col("label"))))
    edges = with_group_position(V.induced_subgraph(weights, nodes, min_weight), ["project"], ["a", "b"], "_r")
    parts.append(lines(projects, 2, 0, F.lit("")))
    parts.append(lines(edges.withColumn("_r", F.col("_r") + 1), 2, "_r", F.format_string(
        '  "%s" -> "%s" [label="%.3f (%d)", weight=%.3f];', F.col("a"), F.col("b"), F.col("weight"),
        F.col("n_calls"), F.col("weight"))))
    n_edges = edges.groupBy("project").agg(F.count(F.lit(1)).alias("_e"))
    tail = projects.join(n_edges, "project", "left").withColumn("_e", F.coalesce("_e", F.lit(0)))
    parts += [lines(tail, 3, 0, F.lit("")), lines(tail, 3, 1, F.format_string(DOT_EDGES, F.col("_e"))),
              lines(tail, 3, 2, F.format_string(DOT_CALLS, F.col("total"))), lines(tail, 3, 3, F.lit(DOT_END))]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def json_nodes(weights: DataFrame) -> DataFrame:
    """K2 nodes: id, label, package ("" without one)."""
    c = coupled_classes(weights)
    return c.select("project", F.col("class_fqn").alias("id"), N.short_name("class_fqn").alias("label"),
                    N.package_or_empty("class_fqn").alias("package"))


def json_edges(weights: DataFrame, min_weight: float = V.DEFAULT_MIN_WEIGHT) -> DataFrame:
    """K2 edges: source, target, weight, count at or over the threshold."""
    return V.edges_over_threshold(weights, min_weight).select(
        "project", F.col("a").alias("source"), F.col("b").alias("target"), "weight", F.col("n_calls").alias("count"))


def modules_csv_rows(modules: DataFrame, members: DataFrame, analyzer: str | None = None) -> DataFrame:
    """K4 in long form: one row per (module, class); a joined cell would have no bound."""
    j = members.join(modules, ["project", "module_id"])
    cols = ["project", "module_id", "class_count", "avg_coupling", "class_fqn"]
    out = j.select(*cols)
    if analyzer:
        out = out.withColumn("analyzer", F.lit(analyzer))
    return out


def modules_csv_cells(modules: DataFrame, members: DataFrame, analyzer: str | None = None,
                      cell_items: int = 100_000) -> DataFrame:
    """K4 as the tool prints it: (project, module_no, module_id, class_count, average, part, classes[, analyzer]).

    ``classes`` joins the class names by ';', in order.  A module of more than ``cell_items`` classes has
    further rows (part 1, 2, ...) that go on with its classes; its other columns are repeated."""
    cells = ordered_cells(members, ["project", "module_id"], "class_fqn", ";", "classes", cell_items)
    out = cells.join(modules, ["project", "module_id"]).select(
        "project", "module_no", "module_id", "class_count", F.format_string("%.3f", "avg_coupling").alias("average"), "part", "classes")
    return out.withColumn("analyzer", F.lit(analyzer)) if analyzer else out


def write_lines(rows: DataFrame, order_cols, text: str, path: str) -> DataFrame:
    """Writes column ``text`` of ``rows`` as text files in the order of ``order_cols``; returns the manifest.

    Rows are range-sorted, so every file holds a stretch of lines and the files in name order are the whole; no
    task sees more than its stretch.  The manifest, written beside them as ``<path>.manifest``, has one row
    per file: (file, first_line, lines), with lines counted from 0.  A line must not hold a line end."""
    rows.orderBy(*order_cols).select(F.col(text).alias("value")).write.mode("overwrite").text(path)
    files = _blocks(rows.sparkSession.read.text(path)).groupBy("file").agg(F.count(F.lit(1)).alias("lines"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    manifest = files.select("file", F.coalesce(F.sum("lines").over(earlier), F.lit(0)).alias("first_line"), "lines")
    manifest.write.mode("overwrite").parquet(f"{path}.manifest")
    return rows.sparkSession.read.parquet(f"{path}.manifest")


def _blocks(lines: DataFrame) -> DataFrame:
    return lines.select("value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                        F.monotonically_increasing_id().alias("_at"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, text) of the files that ``write_lines`` wrote, numbered by their manifest.

    Lines are numbered inside the block of a file that one task reads, blocks by their counts."""
    lines = materialize(_blocks(spark.read.text(path)), "lines")
    blocks = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("_before", F.coalesce(F.sum("n").over(earlier), F.lit(0))) \
        .join(spark.read.parquet(f"{path}.manifest").select("file", "first_line"), "file")
    inside = Window.partitionBy("file", "block").orderBy("_at")
    return lines.withColumn("_n", F.row_number().over(inside) - 1).join(starts, ["file", "block"]) \
        .select((F.col("first_line") + F.col("_before") + F.col("_n")).cast("long").alias("line_no"), F.col("value").alias("text"))


def write_dot(lines: DataFrame, path: str) -> None:
    """One folder ``project=...`` per graph, its lines in order (a display graph is a bounded group)."""
    (lines.repartition("project").sortWithinPartitions("project", "section", "ord")
     .select("project", "line").write.mode("overwrite").partitionBy("project").text(path))


def write_json(weights: DataFrame, path: str, min_weight: float = V.DEFAULT_MIN_WEIGHT) -> None:
    json_nodes(weights).write.mode("overwrite").json(f"{path}/nodes")
    json_edges(weights, min_weight).write.mode("overwrite").json(f"{path}/edges")
    t = coupling_total(weights).select("project", F.col("total").alias("totalInterClassEdges"),
                                       F.lit(float(min_weight)).alias("minWeight"),
                                       F.current_timestamp().cast("string").alias("generatedAt"))
    t.write.mode("overwrite").json(f"{path}/metadata")


def write_csv(weights: DataFrame, path: str, min_weight: float = V.DEFAULT_MIN_WEIGHT) -> None:
    """K3: Source,Target,Weight,Count,Percentage sorted by weight descending."""
    rows = V.coupling_csv(weights, min_weight).orderBy(F.col("count").desc(), "source", "target")
    rows.select(F.col("source").alias("Source"), F.col("target").alias("Target"),
                F.format_string("%.6f", "weight").alias("Weight"), F.col("count").alias("Count"),
                F.format_string("%.2f%%", "percentage").alias("Percentage")) \
        .write.mode("overwrite").option("header", True).csv(path)


def write_modules_csv(modules: DataFrame, members: DataFrame, path: str, analyzer: str | None = None) -> None:
    """K4: Module_ID,Class_Count,Average_Coupling,Classes[,Analyzer], one row per module (see ``modules_csv_cells``)."""
    rows = modules_csv_cells(modules, members, analyzer).orderBy("project", "module_no", "part")
    out = rows.select(F.col("module_id").alias("Module_ID"), F.col("class_count").alias("Class_Count"),
                      F.col("average").alias("Average_Coupling"), F.col("classes").alias("Classes"),
                      *([F.col("analyzer").alias("Analyzer")] if analyzer else []))
    out.write.mode("overwrite").option("header", True).csv(path)


#: order columns of the reports that ``write_text`` prints
ORDER = {"statistics": ("project", "line_no", "item_no"), "coupling": ("project", "section", "line_no"),
         "modules": ("project", "section", "module_no", "line_no")}


def write_text(report: DataFrame, path: str, order_cols=None) -> None:
    """K5: report rows in order, one text line each; the order is told from the report's columns."""
    if order_cols is None:
        order_cols = next(o for o in sorted(ORDER.values(), key=len, reverse=True) if set(o) <= set(report.columns))
    write_lines(report, order_cols, "text", path)


# Fixed values of the closing list of written files.
FILES_TITLE = "=== FICHIERS GÉNÉRÉS ==="
FILES_LINES = (("dot", "format Graphviz"), ("json", "format JSON"), ("csv", "rapport CSV"))


def export_summary(weights: DataFrame, packages: DataFrame, paths: dict[str, str]) -> DataFrame:
    """K6 text: the coupling summary of each project and the list of written files."""
    projects = coupling_total(weights)
    out = V.coupling_summary(weights, packages)
    for i, text in enumerate([FILES_TITLE, *[f"• {paths[k]} ({what})" for k, what in FILES_LINES]]):
        out = out.unionByName(projects.select("project", F.lit(7).alias("section"), F.lit(i).cast("long").alias("line_no"),
                                              F.lit(text).alias("text")))
    return out


def export_all(weights: DataFrame, out_dir: str, min_weight: float = V.DEFAULT_MIN_WEIGHT,
               max_nodes: int = V.DEFAULT_MAX_NODES, packages: DataFrame | None = None) -> dict[str, str]:
    """K6: every format at once, with a text summary where ``packages`` are given; returns the paths."""
    paths = {"dot": f"{out_dir}/coupling_graph.dot", "json": f"{out_dir}/coupling_graph.json",
             "csv": f"{out_dir}/coupling_report.csv"}
    write_dot(dot_lines(weights, min_weight, max_nodes), paths["dot"])
    write_json(weights, paths["json"], min_weight)
    write_csv(weights, paths["csv"], min_weight)
    if packages is not None:
        write_text(export_summary(weights, packages, paths), f"{out_dir}/summary.txt")
        paths["text"] = f"{out_dir}/summary.txt"
    return paths
