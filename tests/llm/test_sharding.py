import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from callweave.llm import sharding as S


def jump(key, n):
    """The published algorithm, with unbounded integers cut to 64 bits."""
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash_equals_the_published_algorithm(spark):
    keys = [0, 1, -1, 7, 2**63 - 1, -2**63, 123456789012345] + list(range(50, 250))
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 8, 9, 40):
        got = {r.k: r.s for r in df.select("k", S.jump_hash(F.col("k"), n).alias("s")).collect()}
        assert got == {k: jump(k, n) for k in keys}
    with pytest.raises(ValueError):
        S.jump_hash(F.col("k"), 0)


def test_documents_get_gapless_slots_and_growth_moves_rows_only_into_the_new_shard(make_docs):
    rows = [(i, f"text {i % 7}") for i in range(400)] + [(None, "x"), (500, None), (501, ""), (502, "é" * 1000)] \
        + [(3, "text 3")] * 50 + [(600 + i, "one text of very many") for i in range(300)]
    got = S.shard_documents(make_docs(rows, shard=9, slot="x"), 8).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    texts = defaultdict(set)
    for i, t in rows:
        texts[i].add((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())))
    for r in got:
        by[r.shard].append(r.slot)
        assert (r.size, r.text_crc32) in texts[r.doc_id]
        assert r.shard == jump(r.doc_id or 0, 8) and r.grown_shard in (r.shard, 8) and r.law == "key"
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert S.shard_documents(make_docs([]), 8).count() == 0


def test_other_keys_and_few_groups(make_docs):
    df = S.with_shard(make_docs([(i, "t", f"s{i % 3}") for i in range(60)]), ["source", "doc_id"], 5)
    assert {r.shard for r in df.collect()} <= set(range(5))
    rows = S.with_slots(df.select("doc_id", "shard"), ["doc_id"], 5, groups=5).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append((r.slot, r.doc_id))
    for v in by.values():
        assert [d for _, d in sorted(v)] == sorted(d for _, d in v) and sorted(s for s, _ in v) == list(range(len(v)))


def test_a_row_repeated_ten_million_times(spark):
    from pyspark.sql import functions as F
    docs = spark.range(0, 10_000_000, 1, 8).selectExpr("7L AS doc_id", "'same' AS text").unionByName(
        spark.range(20).selectExpr("id AS doc_id", "concat('t', id) AS text"))
    got = S.shard_documents(docs, 8)
    per = got.groupBy("shard").agg(F.count("*").alias("n"), F.min("slot").alias("lo"), F.max("slot").alias("hi"), F.countDistinct("slot").alias("d"))
    rows = per.collect()
    assert sum(r.n for r in rows) == 10_000_020 and all(r.lo == 0 and r.hi == r.n - 1 and r.d == r.n for r in rows)
