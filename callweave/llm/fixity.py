"""Merkle fixity audit of WARC replicas.

``warc_records`` turns pages into WARC response records laid out in archives; a record is known
by its SHA-256 and by its byte range in the archive.  Each replica has two trees over the same leaves.  A
leaf is a range of record identities (page id and URL, hashed), so a record that is lost or added changes
its own leaf alone, however many records follow it.  The *hash tree* covers the records' SHA-256; the
*offset tree* covers where each record lies: its archive and the gap between it and the record before it
(0 where they follow each other), so a record of another length doesn't disturb those behind it, either.

``audit`` compares the roots of two replicas and descends only into nodes that differ, level by level,
so the work below the root follows the number of faults.  The records of differing leaves are then
aligned by identity and SHA-256, equal ones one to one, and what is left over is reported.

A leaf is hashed from sums of its records' hash words (four of 60 bits) and their number, by partial aggregation: a
page that is repeated a billion times is one row per task.  Inner nodes have at most ``FANOUT`` children.

Defined results: null url or html count as empty; null page ids come first; repeated rows are
records of their own, of which the surplus is reported; an empty table is an empty tree (two empty replicas
agree); records that one replica lacks are reported with a null hash; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callweave.functions.ranking import with_global_index, with_group_position
from callweave.llm.common import materialize

FANOUT = 16  # a power of two
#: records of a leaf on average
LEAF_RECORDS = 16
RECORDS_PER_ARCHIVE = 1024


def warc_record(url: Column, html: Column) -> Column:
    """Bytes of a WARC/1.1 response record, as text: header block, empty line, payload, two line ends."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
                    F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"),
                    F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def warc_records(pages: DataFrame, per_archive: int = RECORDS_PER_ARCHIVE) -> DataFrame:
    """pos, archive, ordinal, page_id, url, record_offset, length, sha256 of each record.

    Records are ordered by page_id, url and hash over the whole table (a range-sorted index); offsets are
    running sums inside an archive.  Pages are hashed where they are read and not shuffled."""
    rec = warc_record(F.col("url"), F.col("html"))
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"),
                        F.octet_length(rec).cast("long").alias("length"), F.sha2(rec, 256).alias("sha256"))
    placed = with_global_index(rows, ["page_id", "url", "sha256"], "pos") \
        .withColumn("archive", F.floor(F.col("pos") / per_archive)) \
        .withColumn("ordinal", F.col("pos") - F.col("archive") * per_archive)
    before = Window.partitionBy("archive").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("record_offset", F.coalesce(F.sum("length").over(before), F.lit(0))).select(
        "pos", "archive", "ordinal", "page_id", "url", "record_offset", "length", "sha256")


def _words(digest: Column) -> list[Column]:
    """Four 60-bit words of a hexadecimal SHA-256."""
    return [F.conv(F.substring(digest, 15 * i + 1, 15), 16, 10).cast("decimal(38,0)") for i in range(4)]


def with_leaves(records: DataFrame, depth: int, fanout: int = FANOUT) -> DataFrame:
    """Records with ``ident``, their leaf ``idx`` in a tree of ``depth`` levels below the root, and ``gap``."""
    bits = fanout.bit_length() - 1
    if bits * depth > 60:
        raise ValueError("a tree has at most 60 bits of leaves")
    ident = F.md5(F.to_json(F.struct("page_id", F.coalesce("url", F.lit("")).alias("url"))))
    before = Window.partitionBy("archive").orderBy("ordinal")  # an archive is a file of limited size
    end = F.lag(F.col("record_offset") + F.col("length")).over(before)
    return records.withColumn("ident", ident).withColumn("gap", F.col("record_offset") - F.coalesce(end, F.lit(0))) \
        .withColumn("idx", F.shiftright(F.conv(F.substring("ident", 1, 15), 16, 10).cast("long"), 60 - bits * depth))


def merkle_levels(leaved: DataFrame, digest: Column, depth: int, fanout: int = FANOUT) -> list[DataFrame]:
    """Tree levels (idx, hash) from the leaves to the root (level ``depth``); an empty table has empty levels."""
    sums = leaved.select("idx", *[w.alias(f"w{i}") for i, w in enumerate(_words(digest))]).groupBy("idx") \
        .agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"w{i}").alias(f"w{i}") for i in range(4)])
    level = materialize(sums.select("idx", F.sha2(F.concat_ws(":", *[F.col(c).cast("string") for c in ("n", "w0", "w1", "w2", "w3")]), 256)
                                    .alias("hash")), "merkle")
    levels = [level]
    for _ in range(depth):
        joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "hash"))), lambda x: F.concat_ws(
            ":", x["idx"].cast("string"), x["hash"])), ";")
        level = materialize(level.groupBy(F.floor(F.col("idx") / fanout).alias("parent"))
                            .agg(F.sha2(joined, 256).alias("hash")).withColumnRenamed("parent", "idx"), "merkle")
        levels.append(level)
    return levels


def differing_leaves(one: list[DataFrame], two: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """Leaves on which two trees of one depth differ, found from the root down; empty where the roots agree."""
    open_ = None
    for a, b in zip(one[::-1], two[::-1]):
        a, b = a.withColumnRenamed("hash", "ha"), b.withColumnRenamed("hash", "hb")
        if open_ is not None:
            up = F.floor(F.col("idx") / fanout)
            a = a.withColumn("up", up).join(open_, "up", "left_semi").drop("up")
            b = b.withColumn("up", up).join(open_, "up", "left_semi").drop("up")
        differ = a.join(b, "idx", "full").filter(~F.col("ha").eqNullSafe(F.col("hb")))
        open_ = materialize(differ.select(F.col("idx").alias("up")), "merkle_open")
        if open_.isEmpty():
            break
    return open_.select(F.col("up").alias("idx"))


def audit(expected: DataFrame, actual: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Records on which two replicas differ: archive, ordinal, page_id, record_offset, length and
    expected_sha256 by the first replica (by the second where the first lacks the record),
    actual_sha256 and actual_offset by the second.  ``fault``: changed (the page has other bytes), missing,
    added, or moved (the same bytes in another archive, or not where the record before it ends)."""
    bits = fanout.bit_length() - 1
    expected, actual = materialize(expected, "replica"), materialize(actual, "replica")
    leaves = max(expected.count(), actual.count()) // LEAF_RECORDS
    depth = -(-leaves.bit_length() // bits)
    e, a = (materialize(with_leaves(r, depth, fanout), "leaves") for r in (expected, actual))
    place = F.sha2(F.concat_ws(":", "ident", "sha256", "archive", "gap"), 256)
    found = differing_leaves(merkle_levels(e, F.col("sha256"), depth, fanout), merkle_levels(a, F.col("sha256"), depth, fanout), fanout) \
        .unionByName(differing_leaves(merkle_levels(e, place, depth, fanout), merkle_levels(a, place, depth, fanout), fanout)).distinct()
    found = materialize(found, "differing_leaves")
    columns = ["archive", "ordinal", "page_id", "record_offset", "length", "sha256", "gap"]

    def side(records: DataFrame, name: str) -> DataFrame:
        """Records of differing leaves, equal ones numbered in order (a repeated record may be most of them)."""
        some = records.join(found, "idx", "left_semi")
        some = with_group_position(some, ["ident", "sha256"], ["archive", "gap", "pos"], "copy")
        return some.select("ident", F.col("sha256").alias("same"), "copy", F.struct(*columns).alias(name))

    def paired(x: DataFrame, y: DataFrame, keys: list[str]) -> DataFrame:
        return x.join(y, keys, "full")

    aligned = materialize(paired(side(e, "e"), side(a, "a"), ["ident", "same", "copy"]), "aligned")
    moved = aligned.filter("e IS NOT NULL AND a IS NOT NULL AND (e.archive <> a.archive OR e.gap <> a.gap)") \
        .select("e", "a", F.lit("moved").alias("fault"))
    # what has no equal: records of one page are different versions of it, as far as both replicas have some
    lone = [aligned.filter(f"{other} IS NULL").select("ident", "same", "copy", own) for own, other in (("e", "a"), ("a", "e"))]
    lone = [with_group_position(x, ["ident"], ["same", "copy"], "version").drop("same", "copy") for x in lone]
    fault = F.when(F.col("a").isNull(), "missing").when(F.col("e").isNull(), "added").otherwise("changed")
    out = paired(*lone, ["ident", "version"]).select("e", "a", fault.alias("fault")).unionByName(moved)
    pick = [F.coalesce(F.col(f"e.{c}"), F.col(f"a.{c}")).alias(c) for c in columns[:5]]
    return out.select(*pick, "fault", F.col("e.sha256").alias("expected_sha256"), F.col("a.sha256").alias("actual_sha256"),
                      F.col("a.record_offset").alias("actual_offset"))


def damaged_replica(pages: DataFrame) -> DataFrame:
    """A second copy of ``pages`` with known faults: one changed letter in the html of every 97th page,
    and an html cut by its last character in every 1009th."""
    n = F.coalesce(F.col("page_id"), F.lit(0))
    html = F.coalesce(F.col("html"), F.lit(""))
    return pages.select("page_id", "url", F.when(F.pmod(n, F.lit(97)) == 13, F.concat(F.lit("~"), F.substr(html, F.lit(2))))
                        .when(F.pmod(n, F.lit(1009)) == 500, F.substr(html, F.lit(1), F.greatest(F.length(html) - 1, F.lit(0))))
                        .otherwise(html).alias("html"))
