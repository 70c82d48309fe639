"""Tree walks over the dendrogram and the module cut.

The node table (see ``cluster.dendrogram``) is flat; nothing stores a class set
per node. Top-down questions ("highest qualifying ancestor", pre-order number,
depth) are answered by pointer doubling: every pass joins the table to itself on
the current jump target, so a tree of depth d needs log2(d) joins whatever its
size, and each pass is a distributed equi-join on (project, node id).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.functions.ranking import ordered_cells, with_group_position
from callweave.session import materialize

DEFAULT_CP = 0.1
# Fixed value: head of the detailed text of a cluster.
DETAILED = "Cluster(%s, coupling=%.3f, level=%d, classes=%d, classes=["


def node_avg_coupling(dendro: DataFrame) -> DataFrame:
    """Average coupling over the class pairs inside each node; 0.0 for one class.

    ``intra_calls`` is carried up the tree (intra_l + intra_r + s), so no pair is
    enumerated: avg = intra / (total * m(m-1)/2)."""
    m = F.col("n_classes")
    half = (m * (m - 1) / 2)
    avg = F.when((m >= 2) & (F.col("total") > 0), F.col("intra_calls") / (F.col("total") * half)) \
        .otherwise(F.lit(0.0))
    return dendro.withColumn("avg_coupling", avg)


def parent_links(dendro: DataFrame) -> DataFrame:
    """(project, node_id, parent, off, skip): off = pre-order step from the parent, skip = leaves of the
    parent that come before the node's own."""
    inner = dendro.filter(F.col("left").isNotNull())
    lsize = dendro.select("project", F.col("node_id").alias("left"), F.col("n_classes").alias("_nl"))
    inner = inner.join(lsize, ["project", "left"])
    lrows = inner.select("project", F.col("left").alias("node_id"), F.col("node_id").alias("parent"),
                         F.lit(1).cast("long").alias("off"), F.lit(0).cast("long").alias("skip"))
    rrows = inner.select("project", F.col("right").alias("node_id"), F.col("node_id").alias("parent"),
                         (2 * F.col("_nl")).cast("long").alias("off"), F.col("_nl").alias("skip"))
    return lrows.unionByName(rrows)


def tree_paths(dendro: DataFrame, qualifies=None) -> DataFrame:
    """Per node: depth, pre-order number, number of leaves before its own (``lo``) and the highest
    qualifying node on its root path.

    ``qualifies``: boolean Column over the node table (None -> never)."""
    links = parent_links(dendro)
    q = qualifies if qualifies is not None else F.lit(False)
    st = (dendro.withColumn("_q", q).join(links, ["project", "node_id"], "left")
          .select("project", "node_id", F.col("parent").alias("jump"),
                  F.when(F.col("parent").isNotNull(), 1).otherwise(0).cast("long").alias("depth"),
                  F.coalesce("off", F.lit(0)).cast("long").alias("pre"),
                  F.coalesce("skip", F.lit(0)).cast("long").alias("lo"),
                  F.when(F.col("_q"), F.col("node_id")).alias("topq")))
    # finished rows (at the root) leave the loop, so they never meet in the join on a null key; an open row
    # points at an open row or at a finished one, and both are looked up
    every = materialize(st, "paths")
    done = every.filter(F.col("jump").isNull())
    running = every.filter(F.col("jump").isNotNull())
    while not running.isEmpty():
        j = done.unionByName(running).select("project", F.col("node_id").alias("jump"), F.col("jump").alias("_j2"),
                                             F.col("depth").alias("_d2"), F.col("pre").alias("_p2"), F.col("lo").alias("_l2"),
                                             F.col("topq").alias("_t2"))
        st = running.join(j, ["project", "jump"]).select(
            "project", "node_id", F.col("_j2").alias("jump"),
            (F.col("depth") + F.col("_d2")).alias("depth"), (F.col("pre") + F.col("_p2")).alias("pre"),
            (F.col("lo") + F.col("_l2")).alias("lo"),
            F.coalesce("_t2", "topq").alias("topq"))
        step = materialize(st, "paths")
        done = done.unionByName(step.filter(F.col("jump").isNull()))
        running = step.filter(F.col("jump").isNotNull())
    st = done
    return st.drop("jump")


#: leaves of one node that are listed by one task
_CHUNK_LEAVES = 100_000


def node_classes(nodes_with_paths: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """H6: (project, node_id, class_fqn), the class set of every node (of those in ``wanted``, if given).

    The leaves below a node are a range ``lo`` .. ``lo + n_classes - 1`` of the leaves in tree order.  Ranges are
    listed, in chunks, and joined by equality on the leaf's place, so the join makes no row that is
    not in the result and a node with all classes is listed by many tasks."""
    nodes = nodes_with_paths.select("project", "node_id", "lo", "n_classes")
    if wanted is not None:
        nodes = nodes.join(wanted.select("project", "node_id").distinct(), ["project", "node_id"], "left_semi")
    chunk = F.lit(_CHUNK_LEAVES)
    hi = F.col("lo") + F.col("n_classes") - 1
    places = nodes.withColumn("_c", F.explode(F.sequence(F.floor(F.col("lo") / chunk), F.floor(hi / chunk)))) \
        .repartition("project", "node_id", "_c") \
        .select("project", "node_id", F.explode(F.sequence(F.greatest("lo", F.col("_c") * chunk), F.least(
            hi, F.col("_c") * chunk + chunk - 1))).alias("place"))
    leaves = nodes_with_paths.filter(F.col("left").isNull()).select("project", F.col("lo").alias("place"), F.col("label").alias("class_fqn"))
    return places.join(leaves, ["project", "place"]).select("project", "node_id", "class_fqn")


def dendrogram_detailed(nodes_with_paths: DataFrame, cell_items: int = 100_000) -> DataFrame:
    """H7, long form: (project, node_id, part, text), the class set by name in the text.

    A set of more than ``cell_items`` classes goes on in parts 1, 2, ...; the texts in order are the whole."""
    inner = nodes_with_paths.filter(F.col("left").isNotNull())
    cells = ordered_cells(node_classes(nodes_with_paths, inner), ["project", "node_id"], "class_fqn", ", ", "_classes", cell_items)
    head = F.format_string(DETAILED, F.col("label"), F.col("sim"), F.col("level"), F.col("n_classes"))
    last = (F.col("part") + 1) * cell_items >= F.col("n_classes")
    text = F.concat(F.when(F.col("part") == 0, head).otherwise(F.lit(", ")), F.col("_classes"), F.when(last, F.lit("])")).otherwise(F.lit("")))
    leaf = nodes_with_paths.filter(F.col("left").isNull()).select(
        "project", "node_id", F.lit(0).cast("long").alias("part"), F.concat(F.lit("Leaf("), F.col("label"), F.lit(")")).alias("text"))
    return cells.join(inner.select("project", "node_id", "label", "sim", "level", "n_classes"), ["project", "node_id"]) \
        .select("project", "node_id", "part", text.alias("text")).unionByName(leaf)


def cut(dendro: DataFrame, cp: float = DEFAULT_CP) -> dict[str, DataFrame]:
    """A node is a module when its average reaches ``cp`` and no ancestor's does.

    Returns ``nodes`` (with avg, depth, pre, module node of each leaf), ``modules``,
    ``members`` and ``unassigned``. A one-class tree has no module (cap floor(1/2) = 0);
    otherwise the cap never binds (modules are disjoint and hold >= 2 classes)."""
    nodes = node_avg_coupling(dendro)
    sizes = dendro.groupBy("project").agg(F.max("n_classes").alias("n_total"))
    nodes = nodes.join(sizes, "project")
    q = (F.col("avg_coupling") >= F.lit(float(cp))) & (F.col("n_total") >= 2)
    paths = tree_paths(nodes, q)
    nodes = materialize(nodes.join(paths, ["project", "node_id"]), "nodes")
    leaves = nodes.filter(F.col("left").isNull())
    members_raw = leaves.filter(F.col("topq").isNotNull()).select(
        "project", F.col("topq").alias("module_node"), F.col("label").alias("class_fqn"))
    mod_nodes = nodes.join(members_raw.select("project", F.col("module_node").alias("node_id")).distinct(),
                           ["project", "node_id"])
    mod_nodes = with_group_position(mod_nodes, ["project"], ["pre"], "_pos")
    modules = mod_nodes.select("project", (F.col("_pos") + 1).alias("module_no"),
                               F.concat(F.lit("Module_"), F.col("label")).alias("module_id"),
                               F.col("node_id").alias("module_node"),
                               F.col("n_classes").alias("class_count"), "avg_coupling")
    members = members_raw.join(modules.select("project", "module_node", "module_id"), ["project", "module_node"]) \
        .select("project", "module_id", "class_fqn")
    unassigned = leaves.filter(F.col("topq").isNull()).select("project", F.col("label").alias("class_fqn"))
    return {"nodes": nodes, "modules": modules.drop("module_node"), "members": members,
            "unassigned": unassigned}


def module_constraints(dendro: DataFrame, modules: DataFrame, cp: float = DEFAULT_CP) -> DataFrame:
    """M/2 cap and CP check, one row per project."""
    n = dendro.groupBy("project").agg(F.max("n_classes").alias("n_classes"))
    m = modules.groupBy("project").agg(F.count(F.lit(1)).alias("n_modules"),
                                       F.min("avg_coupling").alias("_min"))
    j = n.join(m, "project", "left")
    nm = F.coalesce("n_modules", F.lit(0))
    return j.select("project", "n_classes", F.floor(F.col("n_classes") / 2).cast("long").alias("max_modules"),
                    nm.alias("n_modules"), (nm <= F.floor(F.col("n_classes") / 2)).alias("m2_ok"),
                    F.coalesce(F.col("_min") >= F.lit(float(cp)), F.lit(True)).alias("cp_ok"))


def module_summary(dendro: DataFrame, modules: DataFrame, cp: float | None = None) -> DataFrame:
    """I8: minimum coupling used: min of module averages (0.0 when none), or the CP
    argument for the typed front end."""
    n = dendro.groupBy("project").agg(F.max("n_classes").alias("n_classes"))
    m = modules.groupBy("project").agg(F.count(F.lit(1)).alias("n_modules"),
                                       F.min("avg_coupling").alias("_min"))
    used = F.lit(float(cp)) if cp is not None else F.coalesce("_min", F.lit(0.0))
    return n.join(m, "project", "left").select("project", "n_classes",
                                               F.coalesce("n_modules", F.lit(0)).alias("n_modules"),
                                               used.alias("min_coupling_used"))


def dendrogram_text(dendro: DataFrame) -> DataFrame:
    """H7: short node text."""
    txt = F.when(F.col("left").isNull(), F.concat(F.lit("Leaf("), F.col("label"), F.lit(")"))).otherwise(
        F.format_string("Cluster(%s, coupling=%.3f, classes=%d)", F.col("label"), F.col("sim"), F.col("n_classes")))
    return dendro.select("project", "node_id", txt.alias("text"))


def dendrogram_listing(nodes_with_paths: DataFrame) -> DataFrame:
    """H8: indented pre-order listing (one row per node, ordered by ``pre``)."""
    ind = F.expr("repeat('  ', cast(depth as int))")
    leaf = F.concat(ind, F.lit("└─ "), F.col("label"))
    inner = F.concat(ind, F.lit("├─ "), F.col("label"),
                     F.format_string(" (couplage: %.3f, classes: %d)", F.col("sim"), F.col("n_classes")))
    return nodes_with_paths.select("project", "pre", "depth",
                                   F.when(F.col("left").isNull(), leaf).otherwise(inner).alias("text"))


# Lines of the module report, in their order.
REPORT = {
    "general": "INFORMATIONS GÉNÉRALES:",
    "classes": "- Nombre total de classes: ",
    "modules": "- Nombre de modules identifiés: ",
    "min_coupling": "- Couplage minimum requis: %.3f",
    "found": "MODULES IDENTIFIÉS:",
    "module": "%d. %s (classes: %d, couplage moyen: %.3f)",
    "details": "=== STATISTIQUES DÉTAILLÉES ===",
    "detail": "Module %d: %s",
    "count": "  - Nombre de classes: %d",
    "mean": "  - Couplage moyen: %.3f",
    "members": "  - Classes:",
}


def module_report(dendro: DataFrame, modules: DataFrame, members: DataFrame, cp_used: float | None = None,
                  analyzer: str | None = None) -> DataFrame:
    """Module report as rows (project, section, module_no, line_no, text).

    Section 0 holds the general figures, section 1 one line per module, section 2 the details of
    each module with one row per class (by name) under its ``- Classes:`` line.  Rows in the
    order (project, section, module_no, line_no) are the printed report."""
    summ = module_summary(dendro, modules, cp_used)
    title = "=== RAPPORT DE CLUSTERING HIÉRARCHIQUE" + (f" ({analyzer})" if analyzer else "") + " ==="

    def gen(line_no, text):
        return summ.select("project", F.lit(0).alias("section"), F.lit(0).cast("long").alias("module_no"),
                           F.lit(line_no).cast("long").alias("line_no"), text.alias("text"))

    rows = [gen(0, F.lit(title)), gen(1, F.lit(REPORT["general"])),
            gen(2, F.concat(F.lit(REPORT["classes"]), F.col("n_classes").cast("string"))),
            gen(3, F.concat(F.lit(REPORT["modules"]), F.col("n_modules").cast("string"))),
            gen(4, F.format_string(REPORT["min_coupling"], F.col("min_coupling_used")))]
    if analyzer:
        rows.append(gen(5, F.lit(f"- Analyseur utilisé: {analyzer}")))
    rows.append(gen(6, F.lit(REPORT["found"])))
    rows.append(modules.select("project", F.lit(1).alias("section"), "module_no", F.lit(0).cast("long").alias("line_no"),
                               F.format_string(REPORT["module"], F.col("module_no"),
                                               F.col("module_id"), F.col("class_count"),
                                               F.col("avg_coupling")).alias("text")))
    rows.append(gen(0, F.lit(REPORT["details"])).withColumn("section", F.lit(2)))
    for i, txt in enumerate([F.format_string(REPORT["detail"], F.col("module_no"), F.col("module_id")),
                             F.format_string(REPORT["count"], F.col("class_count")),
                             F.format_string(REPORT["mean"], F.col("avg_coupling")),
                             F.lit(REPORT["members"])]):
        rows.append(modules.select("project", F.lit(2).alias("section"), "module_no",
                                   F.lit(i).cast("long").alias("line_no"), txt.alias("text")))
    ranked = with_group_position(members, ["project", "module_id"], ["class_fqn"], "_r")
    rows.append(ranked.join(modules.select("project", "module_id", "module_no"), ["project", "module_id"])
                .select("project", F.lit(2).alias("section"), "module_no", (F.col("_r") + 4).alias("line_no"),
                        F.col("class_fqn").alias("text")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
