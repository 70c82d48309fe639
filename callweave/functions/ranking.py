"""Ranking helpers that never funnel a table through one task.

* ``with_global_index`` (T2): 0-based position in a total order. Range-partitioned
  sort, then per-partition counts turned into offsets (one row per partition, so the
  offsets table is bounded by the partition count and safe to broadcast).
* ``with_group_position``: position inside a group from the same sorted partitions, joined
  per (partition, group), so a group holding most rows stays spread over its partitions.
* ``with_group_sum``: running sum inside a group, over the same sorted partitions.
* ``spread_join``: join with one row per key, salted on the large side.
* ``counted_join``: join with one row per key whose number of rows is known; hot keys apart.
* ``split_join``: join where heavy keys are found by a mergeable sketch and kept apart.
* ``asof_join``: the last earlier row of the same key, over sorted partitions.
* ``ordered_cells``: ordered string aggregation with continuation rows.
* ``top_percent`` (T1) and ``top_k_per_group`` (salted two-stage window).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callweave.session import ensure_checkpoint_dir, materialize

_PID_SHIFT = 33  # monotonically_increasing_id keeps the partition id in the upper bits


def _cols(cols: Sequence) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def spread_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
                salts: int | None = None) -> DataFrame:
    """Join a large side with a side of one row per key, where one key may hold most of ``left``.

    The right rows are repeated over ``salts`` values and every left row takes one of them by its
    hash, so a hot key is dealt over that many tasks (as many as there are shuffle partitions, unless
    given) whatever the sizes are estimated at."""
    n = salts or max(8, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(n)))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")


#: keys that hold more than one in this many rows are joined by broadcast: there are fewer than this
HOT_KEYS = 4096


def counted_join(rows: DataFrame, table: DataFrame, keys: Sequence[str], count: str, how: str = "inner",
                 total: int | None = None, hot_keys: int = HOT_KEYS) -> DataFrame:
    """``rows`` joined with ``table``, which has one row per key and in ``count`` at least the key's number of rows.

    Keys above a ``hot_keys``-th of ``total`` (the sum of ``count`` where not given) are fewer than ``hot_keys``
    whatever the data, so their side is broadcast and their rows stay where they are; all others are joined by
    key, where no key holds more than that share.  Both tables are read twice and should be written ones."""
    if total is None:
        total = table.agg(F.sum(count)).first()[0] or 0
    limit = total // hot_keys + 1
    hot = F.broadcast(table.filter(F.col(count) > limit))
    rest = rows.join(hot.select(*keys), list(keys), "left_anti").join(table.filter(F.col(count) <= limit), list(keys), how)
    return rows.join(hot, list(keys)).unionByName(rest)


#: a key is heavy from this share of the rows on; at most HEAVY_KEYS are told apart
HEAVY_SHARE, HEAVY_KEYS, _HEAVY_TRACKED = 1 / 256, 1024, 16_384


def heavy_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that hold at least ``HEAVY_SHARE`` of ``rows`` (and perhaps a few others): at most HEAVY_KEYS rows.

    They come from a mergeable frequent-items sketch: every task keeps a table of fixed size, whose error is
    below 4 in ``_HEAVY_TRACKED`` rows, far less than the share asked for.  Null keys are left out."""
    whole = rows.select(*[F.col(k).cast("string").alias(f"_k{i}") for i, k in enumerate(keys)]).na.drop()
    item = F.to_json(F.struct(*[f"_k{i}" for i in range(len(keys))]))
    found = whole.select(item.alias("_item")).agg(
        F.expr(f"approx_top_k(_item, {HEAVY_KEYS}, {_HEAVY_TRACKED})").alias("_top"), F.count(F.lit(1)).alias("_rows"))
    top = found.select(F.explode("_top").alias("_t"), "_rows").filter(F.col("_t.count") >= F.col("_rows") * HEAVY_SHARE)
    schema = ", ".join(f"_k{i} string" for i in range(len(keys)))
    out = top.select(F.from_json("_t.item", schema).alias("_k"))
    return out.select(*[F.col(f"_k._k{i}").cast(rows.schema[k].dataType).alias(k) for i, k in enumerate(keys)])


def split_join(rows: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """``rows`` joined with ``table`` (one row per key), where one key may hold most of ``rows``.

    Rows of heavy keys meet their at most HEAVY_KEYS table rows by broadcast and stay where they are; all
    others are joined by key.  With ``how`` "left" rows with a null key stay too, without a match."""
    k = list(keys)
    heavy = F.broadcast(materialize(heavy_keys(rows, k), "heavy_keys").withColumn("_heavy", F.lit(True)))
    marked = rows.join(heavy, k, "left")
    null = F.lit(False)
    for c in k:
        null = null | F.col(c).isNull()
    apart = F.col("_heavy").isNotNull() | null
    few = F.broadcast(table.join(heavy.drop("_heavy"), k, "left_semi"))
    return marked.filter(apart).drop("_heavy").join(few, k, how) \
        .unionByName(marked.filter(~apart).drop("_heavy").join(table, k, how))


def asof_join(rows: DataFrame, history: DataFrame, keys: Sequence[str], at: Column, since: Column,
              values: Sequence[str]) -> DataFrame:
    """``rows`` with ``values`` of the last row of ``history`` that has the same keys and ``since`` <= ``at``.

    ``at`` and ``since`` are orderable columns of one type; several history rows at one place must agree or
    be told apart by ``since``.  Both sides are sorted together by (keys, place) over range partitions;
    each partition hands the last value of a key on to the next ones (one row per partition and key), so a
    key with most of the rows is spread like any other.  Rows with a null key have null values."""
    k, own = list(keys), rows.columns
    row_type = rows.select(F.struct(*own).alias("r")).schema["r"].dataType
    val_type = history.select(F.struct(*values).alias("v")).schema["v"].dataType
    keyed = [F.col(c).isNotNull() for c in k]
    known = keyed[0]
    for c in keyed[1:]:
        known = known & c
    both = rows.filter(known).select(*k, at.alias("_place"), F.lit(1).alias("_kind"), F.struct(*own).alias("_row"),
                                     F.lit(None).cast(val_type).alias("_val")) \
        .unionByName(history.filter(known).select(*k, since.alias("_place"), F.lit(0).alias("_kind"),
                                                  F.lit(None).cast(row_type).alias("_row"), F.struct(*values).alias("_val")))
    lines, _ = _sorted_rows(both, [*k, "_place", "_kind"])
    so_far = Window.partitionBy("_pid", *k).orderBy("_local").rowsBetween(Window.unboundedPreceding, 0)
    lasts = lines.groupBy("_pid", *k).agg(F.max_by("_val", F.when(F.col("_val").isNotNull(), F.col("_local"))).alias("_last"))
    earlier = Window.partitionBy(*k).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.select("_pid", *k, F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    found = lines.withColumn("_seen", F.last("_val", ignorenulls=True).over(so_far)).filter("_kind = 1") \
        .join(carried, ["_pid", *k]).withColumn("_seen", F.coalesce("_seen", "_carried"))
    out = found.select("_row.*", *[F.col(f"_seen.{v}").alias(v) for v in values])
    rest = rows.filter(~known)
    for v in values:
        rest = rest.withColumn(v, F.lit(None).cast(history.schema[v].dataType))
    return out.unionByName(rest)


def ordered_cells(rows: DataFrame, group_cols: Sequence[str], item: str, sep: str, name: str,
                  cell_items: int = 100_000) -> DataFrame:
    """(group, part, ``name``): the items of each group in order, joined to cells of at most ``cell_items``.

    A group that fits is one row with part 0; a larger one goes on in parts 1, 2, ..., whose cells
    joined with ``sep`` are the whole, so nothing is lost and no cell grows without bound.  Items are
    ranked by ``with_group_position`` and joined in two levels (runs of 1,000, then cells)."""
    g = list(group_cols)
    ranked = with_group_position(rows.select(*g, item), g, [item], "_pos")
    runs = ranked.withColumn("_run", F.floor(F.col("_pos") / 1000)).withColumn("part", F.floor(F.col("_pos") / cell_items)) \
        .groupBy(*g, "part", "_run").agg(F.sort_array(F.collect_list(F.struct("_pos", item))).alias("_a")) \
        .select(*g, "part", "_run", F.array_join(F.col(f"_a.{item}"), sep).alias("_text"))
    return runs.groupBy(*g, "part").agg(F.sort_array(F.collect_list(F.struct("_run", "_text"))).alias("_a")) \
        .select(*g, "part", F.array_join(F.col("_a._text"), sep).alias(name))


def _sorted_rows(df: DataFrame, order_cols: Sequence) -> tuple[DataFrame, DataFrame]:
    """The rows in order, written once, with ``_pid`` and ``_local`` (position in the partition), and
    the first position ``_off`` of each partition."""
    ensure_checkpoint_dir(df.sparkSession)
    tagged = (df.orderBy(*_cols(order_cols))
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    tagged = materialize(tagged, "index")
    written = tagged.written
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), _PID_SHIFT)
    rows = tagged.withColumn("_local", local).drop("_mid")
    rows.written = written
    return rows, offsets


def with_global_index(df: DataFrame, order_cols: Sequence, name: str = "idx") -> DataFrame:
    """Add ``name``: position of each row in the order ``order_cols`` (must be total).

    The sorted, id-tagged rows are written once (``materialize``) so the counting pass
    and the numbering pass see the same partitioning (range bounds come from sampling).
    Parquet keeps the row order of each written file, and each file is one partition.
    """
    rows, offsets = _sorted_rows(df, order_cols)
    return (rows.join(F.broadcast(offsets), "_pid")
            .withColumn(name, (F.col("_off") + F.col("_local")).cast("long"))
            .drop("_pid", "_local", "_off"))


def with_group_position(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence,
                        name: str = "pos", count_name: str | None = None) -> DataFrame:
    """0-based position inside each group (and optionally the group size).

    Group starts are joined per (range partition, group): a group that spans many partitions is
    many keys, none larger than a partition.  The table of starts has at most one row more per
    partition than there are groups."""
    g = list(group_cols)
    rows, offsets = _sorted_rows(df, [*g, *order_cols])
    parts = rows.groupBy("_pid", *g).agg(F.count(F.lit(1)).alias("_k"), F.min("_local").alias("_first"))
    in_group = Window.partitionBy(*g).orderBy("_pid")
    before = in_group.rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("_pid", *g, "_first", F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_before"),
                          F.sum("_k").over(Window.partitionBy(*g)).alias("_total"))
    out = (rows.join(starts, ["_pid", *g])
           .withColumn(name, (F.col("_before") + F.col("_local") - F.col("_first")).cast("long")))
    if count_name:
        out = out.withColumn(count_name, F.col("_total"))
    out = out.drop("_pid", "_local", "_first", "_before", "_total")
    out.written = rows.written
    return out


def with_group_sum(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence, value: str,
                   name: str = "before") -> DataFrame:
    """``name``: sum of ``value`` over the rows of the same group that come before.

    The order must be total and group columns not null.  Rows are summed inside their range partition, and a
    group's partitions (one row each) give its offsets, so a group may span any number of tasks."""
    g = list(group_cols)
    rows, _ = _sorted_rows(df, [*g, *order_cols])
    parts = rows.groupBy("_pid", *g).agg(F.sum(value).alias("_v"))
    earlier = Window.partitionBy(*g).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("_pid", *g, F.coalesce(F.sum("_v").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_pid", *g).orderBy("_local").rowsBetween(Window.unboundedPreceding, -1)
    out = rows.withColumn("_inner", F.coalesce(F.sum(value).over(inside), F.lit(0))).join(starts, ["_pid", *g]) \
        .withColumn(name, F.col("_offset") + F.col("_inner")).drop("_pid", "_local", "_offset", "_inner")
    out.written = rows.written
    return out


def top_percent(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence, percent: float,
                name: str = "rank") -> DataFrame:
    """The first ``max(1, ceil(n * percent))`` rows of each group, 1-based ``rank``."""
    pos = with_group_position(df, group_cols, order_cols, "_pos", "_n")
    keep = F.greatest(F.lit(1), F.ceil(F.col("_n") * F.lit(percent)))
    return (pos.filter(F.col("_pos") < keep)
            .withColumn(name, (F.col("_pos") + 1).cast("long"))
            .drop("_pos", "_n"))


def top_k_per_group(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence, k: int,
                    name: str = "rank", buckets: int | None = None) -> DataFrame:
    """First ``k`` rows per group, 1-based ``rank``; a hot group is cut in ``buckets`` first (as many as
    there are shuffle partitions unless given)."""
    g = list(group_cols)
    buckets = buckets or max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    oc = _cols(order_cols)
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(buckets))
    w1 = Window.partitionBy(*g, "_salt").orderBy(*oc)
    w2 = Window.partitionBy(*g).orderBy(*oc)
    stage1 = (df.withColumn("_salt", salt)
              .withColumn("_r1", F.row_number().over(w1))
              .filter(F.col("_r1") <= k)
              .drop("_salt", "_r1"))
    return (stage1.withColumn(name, F.row_number().over(w2).cast("long"))
            .filter(F.col(name) <= k))


def ceil_keep(n: int, percent: float) -> int:
    """Scalar form of the T1 row count (used by tests)."""
    return 0 if n == 0 else max(1, math.ceil(n * percent))
