from callweave.operators import cluster as CL
from callweave.operators import modules as MO
from tests.test_cluster import _pairs


def reference_cut(nodes, root, cp):
    """Top-down recursion: a node whose average reaches cp is a module, else split."""
    out = []

    def avg(r):
        m = r.n_classes
        return 0.0 if m < 2 else r.intra_calls / (r.total * (m * (m - 1) / 2))

    def walk(i):
        r = nodes[i]
        if r.left is None:
            if avg(r) >= cp:
                out.append(i)
            return
        if avg(r) >= cp:
            out.append(i)
        else:
            walk(r.left)
            walk(r.right)

    walk(root)
    return out


def test_cut_matches_recursion(spark):
    edges = [(0, 1, 9), (1, 2, 1), (2, 3, 8), (3, 4, 1), (4, 5, 7), (0, 5, 1), (6, 7, 2)]
    d = CL.dendrogram(_pairs(spark, edges))
    nodes = {r.node_id: r for r in d.collect()}
    root = max(nodes)
    for cp in [0.0, 0.01, 0.05, 0.1, 0.2, 1.0]:
        res = MO.cut(d, cp)
        got = [r.module_id for r in res["modules"].orderBy("module_no").collect()]
        want = ["Module_" + nodes[i].label for i in reference_cut(nodes, root, cp)]
        assert got == want, cp
        members = res["members"].count()
        unassigned = res["unassigned"].count()
        assert members + unassigned == 8


def test_edge_cases(spark):
    empty = spark.createDataFrame([], "project string, a string, b string, n long")
    d0 = CL.dendrogram(empty)
    assert d0.count() == 0
    assert MO.cut(d0, 0.1)["modules"].count() == 0
    one = spark.createDataFrame([("p", "x.A", "x.B", 3)], "project string, a string, b string, n long")
    d1 = CL.dendrogram(one)
    rows = {r.node_id: r for r in d1.collect()}
    assert len(rows) == 3 and rows[2].left == 0 and rows[2].right == 1 and rows[2].sim == 1.0
    res = MO.cut(d1, 0.0)
    assert [r.module_id for r in res["modules"].collect()] == ["Module_Cluster_1"]
    # CP above every average: no module, every class unassigned
    res = MO.cut(d1, 2.0)
    assert res["modules"].count() == 0 and res["unassigned"].count() == 2
