import glob
import tempfile

from pyspark.sql import functions as F

from callweave.operators import cluster as CL
from callweave.operators import coupling as C
from callweave.operators import modules as MO
from callweave.sinks import export as K
from tests.test_cluster import _pairs


def _read(path, pattern="part-*"):
    lines = []
    for f in sorted(glob.glob(f"{path}/{pattern}")):
        with open(f) as fh:
            lines.extend(fh.read().splitlines())
    return lines


def test_export_all_and_modules_csv(spark):
    edges = [(0, 1, 9), (1, 2, 1), (2, 3, 8), (4, 5, 7)]
    pairs = _pairs(spark, edges).withColumn("project", F.lit("p"))
    w = C.coupling_weights(pairs.withColumnRenamed("n", "n_calls"))
    out = tempfile.mkdtemp(prefix="cw-out-", dir="/tmp")
    paths = K.export_all(w, out, min_weight=0.0, max_nodes=50)
    dot = _read(f"{paths['dot']}/project=p")
    assert dot[0] == "digraph CouplingGraph {" and dot[-1] == "}"
    assert sum(1 for x in dot if " -> " in x) == 4
    assert "  // Total inter-class calls: 25" in dot
    csv = _read(paths["csv"])
    assert csv[0] == "Source,Target,Weight,Count,Percentage" and len(csv) == 5
    assert csv[1].startswith("c00,c01,0.360000,9,36.00%")
    d = CL.dendrogram(pairs)
    res = MO.cut(d, 0.1)
    K.write_modules_csv(res["modules"], res["members"], f"{out}/modules", analyzer="Spoon")
    rows = _read(f"{out}/modules")
    assert rows[0] == "Module_ID,Class_Count,Average_Coupling,Classes,Analyzer"
    assert len(rows) - 1 == res["modules"].count()
    listed = [c for row in rows[1:] for c in row.split(",")[3].split(";")]
    assert sorted(listed) == sorted(r.class_fqn for r in res["members"].collect())
    small = K.modules_csv_cells(res["modules"], res["members"], cell_items=1).orderBy("module_no", "part").collect()
    assert [r.classes for r in small] == [c for r in K.modules_csv_cells(res["modules"], res["members"])
                                          .orderBy("module_no").collect() for c in r.classes.split(";")]


def test_reports_are_written_in_printed_order(spark):
    edges = [(0, 1, 9), (1, 2, 1), (2, 3, 8), (4, 5, 7)]
    pairs = _pairs(spark, edges).select("project", F.concat(F.lit("k."), "a").alias("a"), F.concat(F.lit("k."), "b").alias("b"), "n")
    w = C.coupling_weights(pairs.withColumnRenamed("n", "n_calls"))
    packages = spark.createDataFrame([("p", "k"), ("p", "j")], "project string, package string")
    out = tempfile.mkdtemp(prefix="cw-rep-", dir="/tmp")
    paths = K.export_all(w, out, min_weight=0.0, packages=packages)
    text = _read(paths["text"])
    assert text[0].startswith("=== RÉSUMÉ") and text[1:4] == ["Packages détectés :", "j", "k"]
    assert text[4].startswith("Total inter-class calls") and text[-4] == K.FILES_TITLE and paths["dot"] in text[-3]
    d = CL.dendrogram(pairs)
    res = MO.cut(d, 0.1)
    K.write_text(MO.module_report(d, res["modules"], res["members"]), f"{out}/modules.txt")
    lines = _read(f"{out}/modules.txt")
    at = lines.index("=== STATISTIQUES DÉTAILLÉES ===")
    assert lines.index("MODULES IDENTIFIÉS:") < at and all(x[0].isdigit() for x in lines[lines.index("MODULES IDENTIFIÉS:") + 1:at])
    assert lines[at + 1].startswith("Module 1:") and lines[at + 4] == "  - Classes:" and lines[at + 5].startswith("k.")


def test_package_list_keeps_parents_and_children(spark):
    calls = spark.createDataFrame([("p", c) for c in ("a.b.X", "a.Y", "a.b.c.Z", "ab.W", "q.V", "NoPackage")], "project string, cls string")
    packs = spark.createDataFrame([("p", "a.b"), ("other", "q")], "project string, package string")
    kept = {r.cls for r in C.project_class_filter(calls, "cls", packs).collect()}
    assert kept == {"a.b.X", "a.Y", "a.b.c.Z"}


def test_lines_are_numbered_over_many_files(spark):
    path = tempfile.mkdtemp(prefix="cw-lines-", dir="/tmp") + "/out"
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(0, 5000, 1, 7).selectExpr("id % 2 AS g", "id", "CASE WHEN id % 100 = 0 THEN '' ELSE concat('line ', id) END AS text")
        manifest = K.write_lines(rows, ["g", F.col("id").desc()], "text", path).orderBy("file").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(manifest) > 2 and sum(r.lines for r in manifest) == 5000
    assert [r.first_line for r in manifest] == [sum(x.lines for x in manifest[:i]) for i in range(len(manifest))]
    got = [(r.line_no, r.text) for r in K.read_lines(spark, path).collect()]
    want = ["" if i % 100 == 0 else f"line {i}" for g in (0, 1) for i in range(4999, -1, -1) if i % 2 == g]
    assert sorted(got) == list(enumerate(want))
