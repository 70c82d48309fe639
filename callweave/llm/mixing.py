"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources that hold them).  A small
flow network routes the patterns' tokens to the sources' quotas; each further pass over a
pattern costs more per token (0, 1, 2, ...: convex), so repetition is spread before it is
deepened.  The flow says how many tokens of a pattern go to which source; documents are then
laid on a seeded line per pattern and taken from its start, pass by pass.

A pattern of one source that no other pattern shares needs no network: its flow is the quota, as far as
its passes go, by a join.  Patterns that overlap are solved per connected component of sources, each in
a task of its own, whose input is one row per pattern.  Sources, targets and patterns are
tables of any length; only sums of them reach the driver.

Positions on the line are prefix sums over range-sorted partitions, so no task holds a whole source.
What is left below a quota is filled by further prefix sums over the documents that still fit,
until none does: a source misses its quota by less than its smallest document that may still be repeated.

Defined results: a null text has size 0; a null source is a source of its own (ordered last);
a document without any source is never taken; identical rows are told apart only by an
arbitrary order between them; an empty table gives an empty result; columns of any name are carried by
``apply_mix`` and ignored elsewhere.
"""

from __future__ import annotations

from collections import deque
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.functions.ranking import with_global_index, with_group_position, with_group_sum
from callweave.llm.common import join_counted, materialize
from callweave.llm.components import connected_components
from callweave.session import discard

REPEATS = 3
SEED = 20_260
WEIGHTS = (5.0, 2.0, 1.0)
ARCS = "array<struct<lo:bigint,hi:bigint,source:string>>"


# --- the flow of one component ------------------------------------------------------------------
class _Flow:
    """Successive shortest paths on a small network with whole capacities and costs."""

    def __init__(self, n: int):
        self.out: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.left: list[int] = []
        self.cost: list[int] = []

    def arc(self, a: int, b: int, capacity: int, cost: int) -> int:
        k = len(self.to)
        for u, v, c, w in ((a, b, capacity, cost), (b, a, 0, -cost)):
            self.out[u].append(len(self.to))
            self.to.append(v)
            self.left.append(c)
            self.cost.append(w)
        return k

    def run(self, s: int, t: int) -> None:
        while True:
            dist: list[float] = [float("inf")] * len(self.out)
            via = [-1] * len(self.out)
            dist[s], queue, waiting = 0, deque([s]), {s}
            while queue:
                u = queue.popleft()
                waiting.discard(u)
                for k in self.out[u]:
                    v = self.to[k]
                    if self.left[k] > 0 and dist[u] + self.cost[k] < dist[v]:
                        dist[v], via[v] = dist[u] + self.cost[k], k
                        if v not in waiting:
                            waiting.add(v)
                            queue.append(v)
            if via[t] < 0:
                return
            path, v = [], t
            while v != s:
                path.append(via[v])
                v = self.to[via[v] ^ 1]
            push = min(self.left[k] for k in path)
            for k in path:
                self.left[k] -= push
                self.left[k ^ 1] += push


def route(patterns: list[tuple[tuple, int]], quotas: dict, repeats: int = REPEATS) -> list[list[tuple]]:
    """For each (sources, tokens) pattern: [(source, tokens)] in source order, at least total cost."""
    names = list(quotas)
    node = {s: 1 + len(patterns) + i for i, s in enumerate(names)}
    sink = 1 + len(patterns) + len(names)
    net, arcs = _Flow(sink + 1), {}
    for s in names:
        net.arc(node[s], sink, quotas[s], 0)
    for i, (sources, tokens) in enumerate(patterns):
        for turn in range(repeats):
            net.arc(0, 1 + i, tokens, turn)
        for s in sources:
            arcs[i, s] = net.arc(1 + i, node[s], repeats * tokens, 0)
    net.run(0, sink)
    return [[(s, net.left[arcs[i, s] ^ 1]) for s in sources if net.left[arcs[i, s] ^ 1] > 0]
            for i, (sources, _) in enumerate(patterns)]


# --- the distributed part -----------------------------------------------------------------------
def source_targets(rows: DataFrame, weights: dict | None, share: float, repeats: int) -> DataFrame:
    """(source, source_size, rows, idx, target) of every source in ``rows`` (sources, size), written.

    Sources are ordered by code point, null last.  Shares of the total go by weight; a target stops at
    ``repeats`` times its source's size and the excess is shared again by weight until none is
    above: each round is one sum over the sources."""
    found = rows.select("size", F.explode("sources").alias("source")).groupBy("source") \
        .agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    found = with_global_index(found, [F.col("source").isNull(), "source"])
    if weights is None:
        found = found.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (
            F.col("idx") % len(WEIGHTS) + 1).cast("int")))
    else:
        given = rows.sparkSession.createDataFrame([(s, float(w)) for s, w in weights.items()], "name string, weight double")
        found = found.join(F.broadcast(given), F.col("source").eqNullSafe(F.col("name"))).drop("name")
    found = materialize(found.withColumn("most", (F.col("source_size") * repeats).cast("double")), "sources")
    total = share * (rows.filter(F.size("sources") > 0).agg(F.sum("size")).first()[0] or 0)
    level, full = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) > F.col("most")
        stopped, held, free = found.agg(F.count(F.when(above, 1)), F.sum(F.when(above, F.col("most"))),
                                        F.sum(F.when(~above, F.col("weight")))).first()
        if stopped == full or not free:
            break
        full, level = stopped, (total - (held or 0.0)) / free
    return found.withColumn("target", F.least(F.col("weight") * F.lit(level), "most") if free else F.col("most")) \
        .select("source", "source_size", "rows", "idx", "target")


def _solve(repeats: int):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        rows = sorted(part.itertuples(index=False), key=lambda r: [(s is None, s or "") for s in r.sources])
        quotas = {s: int(q) for r in rows for s, q in zip(r.sources, r.quotas)}
        out = []
        for r, flows in zip(rows, route([(tuple(r.sources), int(r.n)) for r in rows], quotas, repeats)):
            arcs, at = [], 0
            for s, amount in flows:
                arcs.append({"lo": at, "hi": at + amount, "source": s})
                at += amount
            out.append((list(r.sources), at, arcs))
        return pd.DataFrame(out, columns=["sources", "_flow", "_arcs"])
    return run


def pattern_flows(rows: DataFrame, sources: DataFrame, repeats: int) -> DataFrame:
    """(sources, _tokens, _rows, _flow, _arcs) of every membership pattern, written."""
    patterns = materialize(rows.filter(F.size("sources") > 0).groupBy("sources").agg(
        F.sum("size").alias("n"), F.count(F.lit(1)).alias("_rows")), "patterns")
    named = sources.select(F.col("source").isNull().alias("_null"), F.coalesce("source", F.lit("")).alias("_name"), "idx",
                           F.bround("target").cast("long").alias("quota"))
    each = patterns.select("sources", "n", F.posexplode("sources").alias("_pos", "_one")) \
        .withColumn("_null", F.col("_one").isNull()).withColumn("_name", F.coalesce("_one", F.lit("")))
    each = each.join(named, ["_null", "_name"]).groupBy("sources", "n") \
        .agg(F.sort_array(F.collect_list(F.struct("_pos", "idx", "quota"))).alias("s"))  # as long as the pattern
    each = materialize(each.select("sources", "n", F.col("s.idx").alias("idx"), F.col("s.quota").alias("quotas")), "pattern_quotas")
    links = each.filter(F.size("idx") > 1).select(F.col("idx")[0].alias("a"), F.explode("idx").alias("b")).filter("a <> b")
    links = materialize(links.distinct(), "overlaps")
    flow = F.least(F.col("quotas")[0], F.col("n") * repeats)
    lone = each.withColumn("id", F.col("idx")[0])
    arcs = F.array(F.struct(F.lit(0).cast("long").alias("lo"), F.col("_flow").alias("hi"), F.col("sources")[0].alias("source")))
    if links.isEmpty():
        flows = lone.withColumn("_flow", flow).select("sources", "_flow", arcs.cast(ARCS).alias("_arcs"))
    else:
        parts = materialize(connected_components(links), "overlapping_sources")
        flows = lone.join(parts, "id", "left_anti").withColumn("_flow", flow).select("sources", "_flow", arcs.cast(ARCS).alias("_arcs")) \
            .unionByName(lone.join(parts, "id").select("component", "sources", "n", "quotas").groupBy("component")
                         .applyInPandas(_solve(repeats), f"sources array<string>, _flow bigint, _arcs {ARCS}"))
    return materialize(patterns.join(flows, "sources").withColumnRenamed("n", "_tokens"), "pattern_flows")


def mix(rows: DataFrame, weights: dict | None = None, share: float = 1.0, repeats: int = REPEATS,
        seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(rows with ``taken``, ``times`` and ``routes``; sources with ``source_size``, ``rows`` and ``target``).

    ``rows``: any columns, among them ``sources`` (array of names), ``size`` (long) and ``_row``
    (long hash that tells rows apart).  ``weights`` by source name; WEIGHTS repeating in source
    order where None.  ``routes`` names the source of each pass of the document."""
    rows = rows.withColumn("sources", F.array_sort(F.array_distinct(F.coalesce(
        "sources", F.array().cast("array<string>"))))).withColumn("_at", F.xxhash64(F.lit(seed), "_row"))
    rows = materialize(rows, "mix_rows")
    sources = source_targets(rows, weights, share, repeats)
    return _select(rows, pattern_flows(rows, sources, repeats), repeats), sources


def _select(rows: DataFrame, plan: DataFrame, repeats: int) -> DataFrame:
    planned = join_counted(rows, plan, ["sources"], "_rows", "left").drop("_rows")
    placed = with_group_sum(planned, ["sources"], ["_at", "_row", "size"], "size", "_start")
    line = placed.written
    room = F.col("_flow") - F.col("_start") - F.col("size")  # a pass fits whole below the flow
    times = F.when((F.col("size") > 0) & (room >= 0), F.least(
        F.lit(repeats), F.floor(room / F.greatest("_tokens", F.lit(1))) + 1)).otherwise(0).cast("int")
    placed = materialize(placed.withColumn("times", F.coalesce(times, F.lit(0))), "mix_placed")
    discard(line)
    done = _filled(placed, repeats)
    middle = 2 * (F.col("_start")) + F.col("size")
    last = F.element_at("_arcs", -1)["source"]
    routes = F.when(F.col("times") > 0, F.transform(
        F.sequence(F.lit(0), F.greatest(F.col("times") - 1, F.lit(0))),
        lambda e: F.coalesce(F.get(F.filter("_arcs", lambda a: (a["lo"] * 2 <= middle + e * 2 * F.col("_tokens")) & (
            a["hi"] * 2 > middle + e * 2 * F.col("_tokens"))), F.lit(0))["source"], last)))
    return done.withColumn("taken", F.col("size") * F.col("times")).withColumn("routes", routes) \
        .drop("_at", "_start", "_tokens", "_flow", "_arcs")


def _filled(placed: DataFrame, repeats: int) -> DataFrame:
    """``placed`` with passes added until no document fits below its pattern's flow.

    A round lays the documents that fit on a line, those of the fewest passes first and longer
    ones (by powers of two) before shorter, and takes those that end inside the gap.  It either
    leaves at most 2/3 of the gap or adds a pass to all documents of the fewest passes, so
    rounds grow with the logarithm of the longest document."""
    left = placed.filter("size > 0 AND _flow IS NOT NULL")
    taken = F.sum(F.col("size") * F.col("times"))
    gaps = left.groupBy("sources").agg((F.max("_flow") - taken).alias("_gap"), F.count(F.lit(1)).alias("_rows"))
    left = left.select("sources", "_row", "_start", "size", "times")
    order = ["times", F.col("_level").desc(), "_start", "_row"]
    picks = []
    while True:
        gaps = materialize(gaps.filter("_gap > 0"), "gaps")
        if gaps.isEmpty():
            break
        fits = join_counted(left, gaps, ["sources"], "_rows").drop("_rows") \
            .filter((F.col("size") <= F.col("_gap")) & (F.col("times") < repeats)).withColumn("_level", F.length(F.bin("size")))
        dealt = with_group_sum(fits, ["sources"], order, "size", "_first")
        line = dealt.written
        dealt = materialize(dealt.select("sources", "_row", "_start", "size", "times", "_gap", (
            F.col("_first") + F.col("size") <= F.col("_gap")).cast("int").alias("_more")), "mix_fill")
        discard(line)
        picks.append(dealt.filter("_more > 0").select("sources", "_row", "_start", "_more"))
        gaps = dealt.groupBy("sources").agg((F.max("_gap") - F.sum(F.col("size") * F.col("_more"))).alias("_gap"),
                                            F.count(F.lit(1)).alias("_rows"))
        left = dealt.withColumn("times", F.col("times") + F.col("_more")).drop("_gap", "_more")
    if not picks:
        return placed
    more = reduce(DataFrame.unionByName, picks).groupBy("sources", "_row", "_start").agg(
        F.sum("_more").cast("int").alias("_more"))
    return placed.join(more, ["sources", "_row", "_start"], "left") \
        .withColumn("times", F.col("times") + F.coalesce("_more", F.lit(0))).drop("_more")


def sized_documents(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words `[^\\x20\\x09-\\x0D]+`), ``sources`` and the row's hash."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+"))
    return docs.select("doc_id", "source", words.cast("long").alias("size"),
                       F.array(F.col("source")).alias("sources"), _row_hash().alias("_row"))


def _row_hash() -> Column:
    text = F.coalesce(F.col("text"), F.lit(""))
    return F.xxhash64(F.coalesce(F.col("doc_id"), F.lit(-1)), "source", F.crc32(text), F.length(text))


def mixed_documents(docs: DataFrame, repeats: int = REPEATS, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken, times for every document of single-source ``docs``."""
    taken, sources = mix(sized_documents(docs), None, 1.0, repeats, seed)
    null, name = F.col("source").isNull().alias("_null"), F.coalesce("source", F.lit("")).alias("_name")
    taken = materialize(taken.select("doc_id", "size", "taken", "times", "_row", null, name), "mix_taken")
    return join_counted(taken, sources.select("source_size", "rows", "target", null, name), ["_null", "_name"], "rows") \
        .select("doc_id", "size", "source_size", "target", "taken", "times", "_row")


def apply_mix(docs: DataFrame, repeats: int = REPEATS, seed: int = SEED) -> DataFrame:
    """``docs`` as the mix takes them: a document taken n times is there n times, others go.

    Passes over identical rows are dealt out evenly, in the order of the other columns."""
    plan = mixed_documents(docs, repeats, seed).groupBy("_row").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("times").alias("_all"), F.min("times").alias("_lo"),
        F.max("times").alias("_hi"))
    plan = materialize(plan.filter("_hi > 0"), "mix_plan")
    # the row travels as one column, so its own names cannot clash
    keyed = docs.select(_row_hash().alias("_row"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    even = plan.filter("_lo = _hi").select("_row", F.col("_lo").alias("_times"))
    out = keyed.join(even.hint("merge"), "_row").select("row", "_times")  # as many rows as documents: not to be broadcast
    uneven = plan.filter("_lo < _hi").select("_row", "_n", "_all")
    if not uneven.isEmpty():
        some = with_group_position(keyed.join(uneven, "_row").withColumn("_at", F.xxhash64(F.to_json("row"))), ["_row"], ["_at"], "_pos")
        share = F.floor(F.col("_all") / F.col("_n")) + (F.col("_pos") < F.col("_all") % F.col("_n")).cast("int")
        out = out.unionByName(some.withColumn("_times", share.cast("int")).filter("_times > 0").select("row", "_times"))
    return out.select("row", F.explode(F.sequence(F.lit(1), F.col("_times")))).select("row.*")
