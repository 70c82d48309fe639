"""Average-linkage dendrogram (H0-H8) over a weighted class graph.

Input ``pairs``: (project, a, b, n) one row per unordered class pair with an
integer call count ``n`` > 0. Leaves are numbered 0..n-1 by class name; merge
number ``it`` (0-based, in the order the one-pair-at-a-time greedy makes them)
creates node ``n + it``. Ties are broken like a left-to-right scan of the cluster
list: smaller (rank of earlier cluster, rank of later cluster) first, where the
rank of a merged cluster is its creation position.

Average linkage is reducible: a merge elsewhere never makes a pair better than the better of the two
it replaces.  So a pair that is best for both of its ends stays so whatever other pairs do, and such
pairs may be merged anywhere at any time (Bruynooghe 1978; Murtagh 1983).  That allows two kinds of steps:

* block step: nodes are cut, in the order of their smallest leaf (so by package), into blocks of at most
  ``BLOCK_EDGES`` incident edges, whatever the project.  A task sees all edges of its block's nodes and follows
  nearest-neighbour chains inside it, merging until every chain leaves the block;
* edge step: all mutually best pairs of the whole edge table merge at once.  It takes what the blocks
  cannot: pairs of two blocks, and nodes with more than ``BLOCK_EDGES`` edges, which belong to no block.

Both run over all projects at once; a step ends with the contracted edge table (merged ends
relabelled, parallel edges summed).  Finished components have no edges left and take no part.

Ties need the order in which the greedy creates clusters.  A cluster's *label* is made once, at its
merge: minus its coupling followed by the label of its earlier child, down to a leaf's (-infinity, id).  Labels
in lexicographic order are the creation order, since active clusters end in different leaves,
a leaf precedes every merge, and a parent's coupling is at most its children's.

Components that share no edge are joined afterwards at coupling 0.0, oldest two
first (closed form: queue items 2t and 2t+1 make item k+t).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.functions.ranking import counted_join, spread_join, with_group_position, with_group_sum
from callweave.session import discard, materialize

#: incident edges of the nodes of one block: 20 bytes each in its task, up to 32 while nodes merge.  Where
#: many pairs are equal, most nodes wait for the same few ones, so an edge step merges few pairs and a graph of many
#: blocks takes many steps
BLOCK_EDGES = 24_000_000
#: a node takes as much of a block as BLOCK_EDGES // BLOCK_NODES of its edges
BLOCK_NODES = 1_000_000
_FRAME_NUMBERS = 200_000  # numbers of a frame of merges
_PACK_EDGES, _PACK_ROWS = 20_000, 400_000  # edges of a packed row, and edges that are packed together
_ID_SHIFT = 32  # id of a merge while the steps run: size << 32 | smallest leaf
_ZERO_CHUNK = 100_000

MERGE_SCHEMA = T.StructType([
    T.StructField("project", T.StringType()),
    T.StructField("it", T.LongType()),
    T.StructField("left", T.LongType()),
    T.StructField("right", T.LongType()),
    T.StructField("s", T.LongType()),
    T.StructField("size", T.LongType()),
    T.StructField("intra", T.LongType()),
    T.StructField("pairs", T.LongType()),
])


# ---------------------------------------------------------------------------
# Leaves
# ---------------------------------------------------------------------------
def leaves(pairs: DataFrame) -> DataFrame:
    """(project, class_fqn, id) with id = rank of the class name in its project, and n."""
    cls = (pairs.select("project", F.col("a").alias("class_fqn"))
           .unionByName(pairs.select("project", F.col("b").alias("class_fqn")))
           .distinct())
    return with_group_position(cls, ["project"], ["class_fqn"], "id", "n")


def id_edges(pairs: DataFrame, leaf: DataFrame) -> DataFrame:
    """(project, a, b, s) with leaf ids, a < b."""
    la = leaf.select("project", F.col("class_fqn").alias("a"), F.col("id").alias("ia"))
    lb = leaf.select("project", F.col("class_fqn").alias("b"), F.col("id").alias("ib"))
    e = pairs.join(la, ["project", "a"]).join(lb, ["project", "b"])
    return e.select("project", F.least("ia", "ib").alias("a"), F.greatest("ia", "ib").alias("b"),
                    F.col("n").cast("long").alias("s"))


# ---------------------------------------------------------------------------
# Steps
# ---------------------------------------------------------------------------
STEP = ("project string, old long, id long, left long, right long, s long, size long, intra long, pairs long, "
        "minleaf long, label array<double>")
_STEP_COLUMNS = [c.split()[0] for c in STEP.split(", ")]




class _Block:
    """Merges of one block: nearest-neighbour chains over the nodes it owns.

    Nodes are numbers 0, 1, ... in the order of their ids, merges the numbers after them.  The neighbours of an owned
    node are two arrays (node, s): at first a stretch of one array of all, after a merge arrays of its own.  They
    name the nodes of the time they were made; ``_refresh`` brings them up to date when they are next looked at.
    A label is a list of cells (head, number of the next cell), whose last one has the head -infinity and a leaf."""

    def __init__(self, nodes: pd.DataFrame, edges: pd.DataFrame | None = None):
        order = np.argsort(np.asarray(nodes["id"], np.int64), kind="stable")
        self.ids = np.asarray(nodes["id"], np.int64)[order]
        n, most = len(order), 2 * len(order)  # n nodes merge at most n - 1 times
        self.n = n

        def column(name, kind=np.int64):
            out = np.zeros(most, kind)
            out[:n] = np.asarray(nodes[name], kind)[order]
            return out
        self.size, self.leaf, self.owned = column("size"), column("minleaf"), column("owned", bool)
        self.intra = [int(v) for v in column("intra")[:n]]
        self.up = np.arange(most, dtype=np.int32)
        labels = nodes["label"]
        labels = (labels if isinstance(labels, pa.Array) else pa.array(list(labels), pa.list_(pa.float64()))).take(pa.array(order))
        self.numbers, long = labels.flatten().to_numpy(), labels.value_lengths().to_numpy()
        self.end = np.cumsum(long)
        inner = np.ones(len(self.numbers), bool)
        inner[self.end - 1] = False
        self.cells = len(self.numbers) - n
        self.head, self.next = np.empty(self.cells + n), np.arange(1, self.cells + n + 1)
        self.head[:self.cells] = self.numbers[inner]
        self.cell = np.zeros(most, np.int64)
        self.cell[:n] = self.end - long - np.arange(n)
        self.next[self.end - 2 - np.arange(n)] = self.numbers[self.end - 1]  # of the last cell: its leaf
        self.flat = {}  # labels of the merges that are still there
        self.parts, self.near = [], {}
        if edges is not None:
            self.add(*(np.asarray(edges[c], np.int64) for c in ("a", "b", "s")))

    def add(self, a, b, s) -> None:
        self.parts.append((np.searchsorted(self.ids, a).astype(np.int32), np.searchsorted(self.ids, b).astype(np.int32), np.array(s)))

    def _read(self) -> None:
        """Neighbours of the owned nodes, node after node, from the edges; those go as they are read."""
        degree = np.zeros(self.n, np.int64)
        for a, b, _ in self.parts:
            degree += np.bincount(a, minlength=self.n) + np.bincount(b, minlength=self.n)
        degree[~self.owned[:self.n]] = 0
        self.start = np.concatenate([[0], np.cumsum(degree)])
        self.to, self.s = np.empty(self.start[-1], np.int32), np.empty(self.start[-1], np.int64)
        place = self.start[:-1].copy()
        while self.parts:
            a, b, s = self.parts.pop()
            for u, v in ((a, b), (b, a)):
                keep = self.owned[u]
                u, v, w = u[keep], v[keep], s[keep]
                order = np.argsort(u, kind="stable")
                u = u[order]
                first = np.flatnonzero(np.diff(u, prepend=-1))
                length = np.diff(first, append=len(u))
                at = place[u] + np.arange(len(u)) - np.repeat(first, length)
                self.to[at], self.s[at] = v[order], w[order]
                place[u[first]] += length

    def _neighbours(self, u: int):
        found = self.near.get(u)
        return found if found is not None else (self.to[self.start[u]:self.start[u + 1]], self.s[self.start[u]:self.start[u + 1]])

    def _tops(self, nodes):
        """The nodes that these are part of by now."""
        up, found = self.up, self.up[nodes]
        while True:
            above = up[found]
            if np.array_equal(above, found):
                break
            up[found] = found = up[above]  # paths are halved
        up[nodes] = found
        return found

    def _refresh(self, u: int, to, s):
        """Neighbours by their present names, once each, without ``u`` itself."""
        now = self._tops(to)
        if not np.array_equal(now, to):
            order = np.argsort(now)
            now, s = now[order], s[order]
            first = np.flatnonzero(np.diff(now, prepend=-1))
            now, s = now[first], np.add.reduceat(s, first)
            if u >= self.n:  # the two ends of the merge were neighbours
                keep = now != u
                now, s = now[keep], s[keep]
            self.near[u] = now, s
        return now, s

    def _first(self, nodes) -> int:
        """The node with the smallest label."""
        if len(nodes) == 1:
            return int(nodes[0])
        cells = self.cell[nodes]
        while True:
            head = self.head[cells]
            low = head.min()
            keep = head == low
            nodes, cells = nodes[keep], cells[keep]
            if len(nodes) == 1:
                return int(nodes[0])
            if low == -np.inf:
                return int(nodes[np.argmin(self.next[cells])])
            cells = self.next[cells]

    def _before(self, u: int, v: int) -> bool:
        return self._first(np.array([u, v])) == u

    def best(self, u: int) -> int | None:
        """The neighbour of ``u`` with the greatest coupling; ties to the earlier pair of clusters.

        Of two pairs with ``u`` the earlier one is that with the smaller other end, on whichever side of ``u`` they are."""
        to, s = self._refresh(u, *self._neighbours(u))
        if not len(to):
            return None
        x = s / (self.size[u] * self.size[to])
        return self._first(to[x == x.max()])

    def merge(self, u: int, v: int, new: int) -> tuple:
        left, right = (u, v) if self._before(u, v) else (v, u)
        (to, s), (to_right, s_right) = self._refresh(left, *self._neighbours(left)), self._refresh(right, *self._neighbours(right))
        linked = int(s[to == right][0])
        size, size_right = int(self.size[left]), int(self.size[right])
        self.size[new], self.leaf[new], self.owned[new] = size + size_right, min(self.leaf[left], self.leaf[right]), True
        self.intra.append(self.intra[left] + self.intra[right] + linked)
        self.head[self.cells], self.next[self.cells] = -(linked / (size * size_right)), self.cell[left]
        self.cell[new] = self.cells
        self.cells += 1
        self.flat[new] = np.concatenate([self.head[self.cells - 1:self.cells], self._label(left)])
        for w in (left, right):
            self.near.pop(w, None)
            self.flat.pop(w, None)
        self.up[left] = self.up[right] = new
        self._refresh(new, np.concatenate([to, to_right]), np.concatenate([s, s_right]))
        return left, right, linked, size * size_right

    def _id(self, u: int) -> int:
        return int(self.ids[u]) if u < self.n else (int(self.size[u]) << _ID_SHIFT) | int(self.leaf[u])

    def _label(self, u: int) -> np.ndarray:
        return self.flat[u] if u >= self.n else self.numbers[self.end[u - 1] if u else 0:self.end[u]]

    def run(self) -> Iterator[tuple]:
        """Merges until every chain ends at a node of another block; a chain that does so can never go on,
        since the best pair of a node stays so for as long as both of its ends are there."""
        self._read()
        own = np.flatnonzero(self.owned[:self.n])
        blocked, gone, todo, new = np.zeros(2 * self.n, bool), np.zeros(2 * self.n, bool), own.tolist(), self.n
        while todo:
            node = todo.pop()
            chain = [] if gone[node] or blocked[node] else [node]
            while chain:
                u = chain[-1]
                v = self.best(u)
                if len(chain) > 1 and v == chain[-2]:
                    del chain[-2:]
                    left, right, s, pairs = self.merge(u, v, new)
                    gone[left] = gone[right] = True
                    yield (None, self._id(new), self._id(left), self._id(right), s, int(self.size[new]), self.intra[new], pairs,
                           int(self.leaf[new]), self._label(new))
                    todo.append(new)
                    new += 1
                elif v is not None and self.owned[v] and not blocked[v]:
                    chain.append(v)
                else:
                    blocked[chain] = True
                    chain = []
        for node, top in zip(own.tolist(), self._tops(own).tolist()):
            if top != node:
                yield (self._id(node), self._id(top), None, None, None, int(self.size[top]), None, None, None, None)


def _steps(project: str, rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    def frame():
        return pa.RecordBatch.from_arrays([pa.array([project] * len(kept), pa.string()), *(
            pa.array(c, pa.list_(pa.float64()) if name == "label" else pa.int64()) for name, c in zip(_STEP_COLUMNS[1:], zip(*kept)))],
            names=_STEP_COLUMNS)
    kept, numbers = [], 0
    for row in rows:
        kept.append(row)
        numbers += 10 + (0 if row[-1] is None else len(row[-1]))
        if numbers > _FRAME_NUMBERS:
            yield frame()
            kept, numbers = [], 0
    if kept:
        yield frame()


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (project, block, a, b, s) -> (project, block, edges): up to ``_PACK_EDGES`` edges of a block as bytes, a, b and s in turn.

    The task of a block then sorts and reads few long rows."""
    def packs(tables):
        rows = pa.Table.from_batches(tables).combine_chunks()
        names = rows.column("project").combine_chunks().dictionary_encode()
        project = pc.fill_null(names.indices, -1).to_numpy(zero_copy_only=False)
        block, a, b, s = (rows.column(c).to_numpy() for c in ("block", "a", "b", "s"))
        order = np.lexsort((block, project))
        project, block = project[order], block[order]
        starts = np.flatnonzero((np.diff(project, prepend=-2) != 0) | (np.diff(block, prepend=-1) != 0))
        cuts = [k for lo, hi in zip(starts, [*starts[1:], len(order)]) for k in range(lo, hi, _PACK_EDGES)]
        out = []
        for lo, hi in zip(cuts, [*cuts[1:], len(order)]):
            here = order[lo:hi]
            k = int(project[lo])
            out.append((names.dictionary[k].as_py() if k >= 0 else None, int(block[lo]), np.concatenate([a[here], b[here], s[here]]).tobytes()))
            if len(out) >= 100 or hi == len(order):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.binary()))],
                                                 names=["project", "block", "edges"])
                out = []

    kept, n = [], 0
    for batch in batches:
        kept.append(batch)
        n += batch.num_rows
        if n >= _PACK_ROWS:
            yield from packs(kept)
            kept, n = [], 0
    if n:
        yield from packs(kept)


def _merge_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows block after block, its nodes (no edges) before its edges as ``_packed`` gives them -> rows of STEP."""
    key, nodes, block = None, [], None

    def numbers(rows, *names):
        return (rows.column(c).to_numpy(zero_copy_only=False) for c in names)

    def opened():
        rows, names = pa.Table.from_batches(nodes), ("id", "size", "intra", "minleaf", "owned")
        frame = dict(zip(names, numbers(rows, *names)))
        return _Block(frame | {"label": rows.column("label").combine_chunks()})

    def turns(values):
        return np.flatnonzero(pc.fill_null(pc.not_equal(values[1:], values[:-1]), True).to_numpy(zero_copy_only=False)) + 1

    for batch in batches:
        cuts = {0, batch.num_rows}
        for c in ("project", "block", "packed"):
            cuts.update(turns(batch.column(c)).tolist())
        cuts = sorted(cuts)
        for lo, hi in zip(cuts, cuts[1:]):
            rows = batch.slice(lo, hi - lo)
            here = rows.column("project")[0].as_py(), rows.column("block")[0].as_py()
            if here != key:
                if key is not None:
                    yield from _steps(key[0], (block or opened()).run())
                key, nodes, block = here, [], None
            if not rows.column("packed")[0].as_py():
                nodes.append(rows)
            else:
                if block is None:
                    block, nodes = opened(), []
                for edges in rows.column("edges"):
                    block.add(*np.frombuffer(edges.as_buffer(), np.int64).reshape(3, -1))
    if key is not None:
        yield from _steps(key[0], (block or opened()).run())


def _block_step(edges: DataFrame, n_edges: int, known: DataFrame) -> DataFrame:
    """Merges inside blocks and the new names of merged nodes (``old`` -> ``id``), see STEP."""
    ends = edges.select("project", F.explode(F.array("a", "b")).alias("id")).groupBy("project", "id") \
        .agg(F.count(F.lit(1)).alias("degree"))
    ends = ends.withColumn("load", F.col("degree") + BLOCK_EDGES // BLOCK_NODES)
    sums = with_group_sum(ends.join(known, ["project", "id"]), ["project"], ["minleaf"], "load", "before")
    line = sums.written
    nodes = materialize(sums.withColumn("block", F.when(F.col("degree") <= BLOCK_EDGES, F.floor(
        F.col("before") / F.lit(BLOCK_EDGES)))).drop("before", "load"), "nodes")
    discard(line)
    found = edges
    for end in ("a", "b"):
        at = nodes.select("project", F.col("id").alias(end), F.col("block").alias(f"block_{end}"), "degree")
        found = counted_join(found, at, ["project", end], "degree", total=2 * n_edges).drop("degree")
    found = found.withColumn("block", F.explode(F.array_distinct(F.array_compact(F.array("block_a", "block_b")))))
    found = materialize(found.select("project", "block", "a", "b", "s"), "block_edges")
    seen = found.select("project", "block", F.explode(F.array("a", "b")).alias("id")).distinct()
    seen = seen.withColumnRenamed("block", "_at").join(nodes, ["project", "id"]).select(
        "project", F.col("_at").alias("block"), F.lit(False).alias("packed"), "id", "size", "intra", "minleaf",
        F.col("block").eqNullSafe(F.col("_at")).alias("owned"), "label")
    packed = found.mapInArrow(_packed, "project string, block long, edges binary").withColumn("packed", F.lit(True))
    lines = seen.unionByName(packed, allowMissingColumns=True)
    # a set number of tasks: merging takes long for the bytes it reads
    spark = edges.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), spark.sparkContext.defaultParallelism)
    step = lines.repartition(tasks, "project", "block").sortWithinPartitions("project", "block", "packed").mapInArrow(_merge_blocks, STEP)
    step = materialize(step, "block_step")
    discard(nodes, found)
    return step


def _edge_step(edges: DataFrame, n_edges: int, known: DataFrame) -> DataFrame:
    """The mutually best pairs of the whole table, as ``_block_step`` gives them."""
    e = edges.withColumn("sim", F.col("s") / (F.col("sa") * F.col("sb")))
    top = e.select("project", F.explode(F.array("a", "b")).alias("id"), "sim").groupBy("project", "id") \
        .agg(F.max("sim").alias("most"), F.count(F.lit(1)).alias("degree"))
    top = materialize(top, "best")
    # labels are compared on the edges alone that are (one of the) best for an end
    for end in ("a", "b"):
        most = top.select("project", F.col("id").alias(end), F.col("most").alias(f"most_{end}"), "degree")
        e = counted_join(e, most, ["project", end], "degree", total=2 * n_edges).drop("degree")
    ties = materialize(e.filter("sim = most_a OR sim = most_b"), "ties")
    attr = ["size", "intra", "minleaf", "label"]
    for end in ("a", "b"):
        ties = ties.join(known.select("project", F.col("id").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in attr]), ["project", end])
    first = F.col("label_a") < F.col("label_b")
    lo, hi = F.when(first, F.col("label_a")).otherwise(F.col("label_b")), F.when(first, F.col("label_b")).otherwise(F.col("label_a"))
    ties = ties.withColumn("k", F.struct(lo.alias("lo"), hi.alias("hi")))
    own = F.array_compact(F.array(F.when(F.col("sim") == F.col("most_a"), F.col("a")), F.when(F.col("sim") == F.col("most_b"), F.col("b"))))
    best = ties.select("project", F.explode(own).alias("id"), "k").groupBy("project", "id").agg(F.min("k").alias("k"))
    for end in ("a", "b"):
        ties = ties.join(best.select("project", F.col("id").alias(end), F.col("k").alias(f"k_{end}")), ["project", end])
    m = ties.filter("k = k_a AND k = k_b")
    size, leaf = F.col("size_a") + F.col("size_b"), F.least("minleaf_a", "minleaf_b")
    null = F.lit(None).cast("long")
    new = m.select(
        "project", null.alias("old"), F.shiftleft(size, _ID_SHIFT).bitwiseOR(leaf).alias("id"),
        F.when(first, F.col("a")).otherwise(F.col("b")).alias("left"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("right"),
        "s", size.alias("size"), (F.col("intra_a") + F.col("intra_b") + F.col("s")).alias("intra"),
        (F.col("size_a") * F.col("size_b")).alias("pairs"), leaf.alias("minleaf"),
        F.concat(F.array(-F.col("sim")), lo).alias("label"))
    new = materialize(new, "edge_step")
    names = new.select("project", F.explode(F.array("left", "right")).alias("old"), "id", *[null.alias(c) for c in ("left", "right", "s")],
                       "size", *[null.alias(c) for c in ("intra", "pairs", "minleaf")], F.lit(None).cast("array<double>").alias("label"))
    discard(top)
    return new.unionByName(names)


def _contract(edges: DataFrame, step: DataFrame) -> DataFrame:
    """Edges between the nodes after ``step``: merged ends relabelled, parallel edges summed."""
    names = step.filter("old IS NOT NULL")
    for end in ("a", "b"):
        new = names.select("project", F.col("old").alias(end), F.col("id").alias("_id"), F.col("size").alias("_size"))
        edges = edges.join(new, ["project", end], "left").withColumn(end, F.coalesce("_id", end)) \
            .withColumn(f"s{end}", F.coalesce("_size", f"s{end}")).drop("_id", "_size")
    flip = F.col("a") > F.col("b")
    edges = edges.filter("a <> b").select(
        "project", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "s",
        F.when(flip, F.col("sb")).otherwise(F.col("sa")).alias("sa"), F.when(flip, F.col("sa")).otherwise(F.col("sb")).alias("sb"))
    return edges.groupBy("project", "a", "b").agg(F.sum("s").alias("s"), F.max("sa").alias("sa"), F.max("sb").alias("sb"))


def merges_rounds(eid: DataFrame, counts: DataFrame) -> tuple[DataFrame, int]:
    """Positive merges by block and edge steps in turn. Returns (merges, steps)."""
    one = F.lit(1).cast("long")
    edges = materialize(eid.select("project", "a", "b", "s", one.alias("sa"), one.alias("sb")), "edges")
    leaf_nodes = edges.select("project", F.explode(F.array("a", "b")).alias("id")).distinct().select(
        "project", "id", one.alias("size"), F.lit(0).cast("long").alias("intra"), F.col("id").alias("minleaf"),
        F.array(F.lit(float("-inf")), F.col("id").cast("double")).alias("label"))
    known = leaf_nodes = materialize(leaf_nodes, "leaf_nodes")
    merges, steps = None, 0
    n_edges = edges.count()
    while n_edges:
        step = (_edge_step if steps % 2 else _block_step)(edges, n_edges, known)
        steps += 1
        new = step.filter("old IS NULL")
        merges = new if merges is None else merges.unionByName(new)
        known = known.unionByName(new.select(*known.columns))
        former, edges = edges, materialize(_contract(edges, step), "edges")
        discard(former)
        n_edges = edges.count()
    if merges is None:
        return eid.sparkSession.createDataFrame([], MERGE_SCHEMA), steps
    # final numbering: position in the creation order; children renamed to final ids
    final = with_group_position(merges.drop("old", "minleaf"), ["project"], ["label"], "it").drop("label")
    final = materialize(spread_join(final, counts.select("project", "n"), ["project"]), "cluster")
    ids = final.select("project", F.col("id").alias("old"), (F.col("n") + F.col("it")).alias("new"))
    lmap = ids.withColumnRenamed("old", "left").withColumnRenamed("new", "left_id")
    rmap = ids.withColumnRenamed("old", "right").withColumnRenamed("new", "right_id")
    out = (final.join(lmap, ["project", "left"], "left").join(rmap, ["project", "right"], "left")
           .select("project", "it", F.coalesce("left_id", "left").alias("left"),
                   F.coalesce("right_id", "right").alias("right"), "s", "size", "intra", "pairs"))
    return out, steps


# ---------------------------------------------------------------------------
# Zero merges and the node table
# ---------------------------------------------------------------------------
def zero_merges(roots: DataFrame, counts: DataFrame) -> DataFrame:
    """H5: join component roots at coupling 0.0, the two oldest first.

    roots(project, node_id, n_classes, intra) in creation order. Queue item i < k is
    root i, item k+t is zero merge t with children items 2t and 2t+1. Read from the
    last item backwards this is a binary-heap layout (h = 2k-2-i, children 2h+1 and
    2h+2), so the roots under a zero merge are found arithmetically: O(k log k) rows.
    Returns (project, t, left, right, n_classes, intra)."""
    q = with_group_position(roots, ["project"], ["node_id"], "qi", "k")
    base = spread_join(q, counts.select("project", "n", "positive"), ["project"])
    k = F.col("k")
    # children of each zero merge, as node ids
    # t = 0..k-2 generated in two levels (chunks, then ids) so no task emits a huge range
    chunk = F.lit(_ZERO_CHUNK)
    ts = (base.filter(k >= 2).select("project", "k", "n", "positive").distinct()
          .select("project", "k", "n", "positive",
                  F.explode(F.sequence(F.lit(0).cast("long"), F.floor((k - 2) / chunk).cast("long"))).alias("c"))
          .repartition("project", "c")
          .select("project", "k", "n", "positive",
                  F.explode(F.sequence(F.col("c") * chunk, F.least(F.col("c") * chunk + chunk - 1, k - 2)))
                  .alias("t")))

    def item_to_node(item, prefix):
        return F.when(item < F.col("k"), F.lit(None).cast("long")).otherwise(
            F.col("n") + F.col("positive") + item - F.col("k")).alias(prefix)

    zm = ts.select("project", "t", "k", "n", "positive",
                   (2 * F.col("t")).alias("li"), (2 * F.col("t") + 1).alias("ri"))
    rq = q.select("project", "qi", "node_id")
    zm = (zm.join(rq.withColumnRenamed("qi", "li").withColumnRenamed("node_id", "lroot"), ["project", "li"], "left")
          .join(rq.withColumnRenamed("qi", "ri").withColumnRenamed("node_id", "rroot"), ["project", "ri"], "left"))
    zm = zm.select("project", "t", "k", "n", "positive",
                   F.coalesce("lroot", item_to_node(F.col("li"), "l")).alias("left"),
                   F.coalesce("rroot", item_to_node(F.col("ri"), "r")).alias("right"))
    # subtree sums: every root item adds its size to its zero-merge ancestors
    h = 2 * k - 2 - F.col("qi")
    depth = (F.length(F.bin(h + 1)) - 1).cast("int")  # floor(log2(h + 1)), exact
    anc = base.filter(k >= 2).select(
        "project", "k", "n_classes", "intra",
        F.explode(F.sequence(F.lit(1), F.greatest(depth, F.lit(1)))).alias("d"), h.alias("h"))
    anc = anc.select("project", "n_classes", "intra",
                     (F.col("k") - 2 - (F.expr("shiftright(h + 1, d)") - 1)).alias("t"))
    sums = anc.groupBy("project", "t").agg(F.sum("n_classes").cast("long").alias("n_classes"),
                                           F.sum("intra").cast("long").alias("intra"))
    return zm.join(sums, ["project", "t"]).select("project", "t", "left", "right", "n_classes", "intra")


def dendrogram(pairs: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """H3-H6: node table (project, node_id, label, left, right, sim, level, n_classes,
    intra_calls, total).

    ``pairs``: (project, a, b, n) with a < b; ``totals``: (project, total) divisor of
    the weights (defaults to the sum of ``n``; a folded directed matrix passes the
    directed total)."""
    if totals is None:
        totals = pairs.groupBy("project").agg(F.sum("n").cast("long").alias("total"))
    tot = totals.select("project", "total")
    leaf = materialize(leaves(pairs), "leaves")
    eid = id_edges(pairs, leaf)
    sizes = eid.groupBy("project").agg(F.count(F.lit(1)).alias("n_edges"))
    counts = leaf.select("project", "n").distinct().join(sizes, "project")
    merges, _ = merges_rounds(eid, counts)
    merges = materialize(merges, "merges")
    pos = merges.groupBy("project").agg(F.count(F.lit(1)).alias("positive"))
    counts = counts.join(pos, "project", "left").withColumn("positive", F.coalesce("positive", F.lit(0)))
    leaf_rows = leaf.select("project", F.col("id").alias("node_id"), F.col("class_fqn").alias("label"),
                            F.lit(None).cast("long").alias("left"), F.lit(None).cast("long").alias("right"),
                            F.lit(0.0).alias("sim"), F.lit(0).alias("level"),
                            F.lit(1).cast("long").alias("n_classes"), F.lit(0).cast("long").alias("intra_calls"))
    pm = spread_join(merges, counts.select("project", "n").join(tot, "project"), ["project"])
    pos_rows = pm.select("project", (F.col("n") + F.col("it")).alias("node_id"),
                         F.concat(F.lit("Cluster_"), (F.col("it") + 1).cast("string")).alias("label"),
                         "left", "right",
                         (F.col("s") / (F.col("total") * F.col("pairs"))).alias("sim"),
                         (F.col("it") + 1).cast("int").alias("level"),
                         F.col("size").alias("n_classes"), F.col("intra").alias("intra_calls"))
    children = merges.select("project", F.col("left").alias("node_id")).unionByName(
        merges.select("project", F.col("right").alias("node_id")))
    nodes = leaf_rows.unionByName(pos_rows)
    roots = (nodes.join(children, ["project", "node_id"], "left_anti")
             .select("project", "node_id", "n_classes", F.col("intra_calls").alias("intra")))
    zm = spread_join(zero_merges(roots, counts), counts.select("project", "n", "positive"), ["project"])
    it = F.col("positive") + F.col("t")
    zero_rows = zm.select("project", (F.col("n") + it).alias("node_id"),
                          F.concat(F.lit("Cluster_"), (it + 1).cast("string")).alias("label"),
                          "left", "right", F.lit(0.0).alias("sim"), (it + 1).cast("int").alias("level"),
                          "n_classes", F.col("intra").alias("intra_calls"))
    return spread_join(nodes.unionByName(zero_rows), tot, ["project"])


def first_round(weights: DataFrame) -> tuple[DataFrame, DataFrame]:
    """H1/H2 for the first round: each leaf's best edge and the mutually best pairs.

    With single-class clusters the linkage is the pair count itself."""
    pairs = weights.select("project", "a", "b", F.col("n_calls").alias("n"))
    leaf = leaves(pairs)
    e = id_edges(pairs, leaf)
    key = F.struct((-F.col("s").cast("double")).alias("ns"), F.col("a"), F.col("b"), F.col("s"))
    ends = (e.select("project", F.col("a").alias("node"), key.alias("k"))
            .unionByName(e.select("project", F.col("b").alias("node"), key.alias("k"))))
    best = ends.groupBy("project", "node").agg(F.min("k").alias("k"))
    best_out = best.select("project", "node", F.col("k.a").alias("best_a"), F.col("k.b").alias("best_b"),
                           F.col("k.s").cast("double").alias("sim"))
    mutual = (best.groupBy("project", F.col("k.a").alias("a"), F.col("k.b").alias("b"))
              .agg(F.count(F.lit(1)).alias("_c"), F.max("k.s").alias("s"))
              .filter(F.col("_c") == 2).drop("_c"))
    return best_out, mutual
