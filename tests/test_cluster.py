"""Clustering against a literal simulation of the one-pair-at-a-time loop."""

import random
from fractions import Fraction

import pytest

from callweave.operators import cluster as CL


def simulate(n, edges):
    """List of clusters in leaf order, merged ones appended; scan i<j, strict '>'."""
    w = {}
    for a, b, s in edges:
        w[(min(a, b), max(a, b))] = s
    clusters = [(i, frozenset([i])) for i in range(n)]
    out = []
    it = 0
    while len(clusters) > 1:
        best, bi, bj = Fraction(-1), None, None
        for i in range(len(clusters)):
            for j in range(i + 1, len(clusters)):
                ci, cj = clusters[i][1], clusters[j][1]
                tot = sum(w.get((min(x, y), max(x, y)), 0) for x in ci for y in cj)
                sim = Fraction(tot, len(ci) * len(cj))
                if sim > best:
                    best, bi, bj = sim, i, j
        (idl, cl), (idr, cr) = clusters[bi], clusters[bj]
        out.append((idl, idr, best))
        clusters = [c for k, c in enumerate(clusters) if k not in (bi, bj)] + [(n + it, cl | cr)]
        it += 1
    return out


def random_graph(rng, n, p, wmax):
    return [(a, b, rng.randint(1, wmax)) for a in range(n) for b in range(a + 1, n) if rng.random() < p]


@pytest.mark.parametrize("block_edges", [CL.BLOCK_EDGES, 6, 1])
def test_many_projects_match_simulation(spark, monkeypatch, block_edges):
    """Random graphs with ties, a chain and a hub, one project each, through the rounds at once."""
    monkeypatch.setattr(CL, "BLOCK_EDGES", block_edges)   # 6: many blocks; 1: edge steps do most of the work
    rng = random.Random(7)
    graphs = [(lambda e: [(a, b, s) for a, b, s in e])(random_graph(
        rng, rng.randint(2, 9), rng.choice([0.3, 0.6, 1.0]), rng.choice([1, 2, 5]))) for _ in range(40)]
    graphs += [[(i, i + 1, i + 1) for i in range(8)], [(0, i, 1) for i in range(1, 9)]]
    graphs = [g for g in graphs if g]
    rows = [(f"p{k:02d}", f"c{a:02d}", f"c{b:02d}", s) for k, g in enumerate(graphs) for a, b, s in g]
    pairs = spark.createDataFrame(rows, "project string, a string, b string, n long")
    got = {}
    for r in CL.dendrogram(pairs).filter("left IS NOT NULL AND sim > 0").collect():
        got.setdefault(r.project, []).append((r.node_id, r.left, r.right))
    for k, g in enumerate(graphs):
        ids = {c: i for i, c in enumerate(sorted({x for e in g for x in e[:2]}))}
        ref = simulate(len(ids), [(ids[a], ids[b], s) for a, b, s in g])
        want = [(len(ids) + i, left, right) for i, (left, right, s) in enumerate(ref) if s > 0]
        assert sorted(got[f"p{k:02d}"]) == want, g


def test_block_of_a_long_chain_needs_no_deep_recursion():
    import pandas as pd
    n = 6000
    nodes = pd.DataFrame({"id": range(n), "size": 1, "intra": 0, "minleaf": range(n),
                          "label": [[float("-inf"), float(i)] for i in range(n)], "owned": True})
    for weight in (lambda i: 1, lambda i: i + 1, lambda i: n - i):
        edges = pd.DataFrame({"a": range(n - 1), "b": range(1, n), "s": [weight(i) for i in range(n - 1)]})
        rows = CL._Block(nodes, edges).run()
        assert sum(r[0] is None for r in rows) == n - 1


def _pairs(spark, edges):
    rows = [("p", f"c{a:02d}", f"c{b:02d}", s) for a, b, s in edges]
    return spark.createDataFrame(rows, "project string, a string, b string, n long")


def test_components_are_joined_oldest_first(spark):
    rng = random.Random(3)
    edges = random_graph(rng, 10, 0.35, 2) + [(10, 11, 1), (12, 13, 3)]
    nodes = CL.dendrogram(_pairs(spark, edges)).collect()
    n = len({x for e in edges for x in e[:2]})
    assert len(nodes) == 2 * n - 1
    assert max(nodes, key=lambda r: r.node_id).n_classes == n


def test_zero_merge_closed_form(spark):
    # three disjoint pairs: roots 3 items -> 2 zero merges (0,1)->3, (2,3)->4
    edges = [(0, 1, 5), (2, 3, 4), (4, 5, 3)]
    d = {r.node_id: r for r in CL.dendrogram(_pairs(spark, edges)).collect()}
    assert (d[9].left, d[9].right, d[9].sim) == (6, 7, 0.0)
    assert (d[10].left, d[10].right, d[10].n_classes, d[10].intra_calls) == (8, 9, 6, 12)


def test_projects_are_independent(spark):
    rng = random.Random(11)
    ea = random_graph(rng, 7, 0.5, 3)
    eb = [(0, 1, 2), (1, 2, 2), (3, 4, 1)]
    rows = [("A", f"c{a:02d}", f"c{b:02d}", s) for a, b, s in ea] + [("B", f"k{a}", f"k{b}", s) for a, b, s in eb]
    pairs = spark.createDataFrame(rows, "project string, a string, b string, n long")
    both = CL.dendrogram(pairs).orderBy("project", "node_id").collect()
    only_b = CL.dendrogram(pairs.filter("project = 'B'")).orderBy("node_id").collect()
    assert [r for r in both if r.project == "B"] == only_b
    assert CL.dendrogram(pairs.limit(0)).count() == 0
