import os
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from callweave.llm import fixity as X
from callweave.llm import packing as P


def scan_best_fit(lengths, capacity):
    room, out = [], []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fit = [k for k in range(len(room)) if room[k] >= lengths[i] > 0 and lengths[i] < capacity]
        if fit:
            least = min(room[k] for k in fit)
            k = [k for k in fit if room[k] == least][-1]
        else:
            k = len(room)
            room.append(capacity)
            out.append([])
        room[k] -= lengths[i]
        out[k].append(i)
    return sorted(sum(lengths[i] for i in b) for b in out)


def test_segment_tree_packs_as_a_scan_does():
    rng = random.Random(2)
    for _ in range(60):
        cap = rng.randint(1, 40)
        lengths = np.array([rng.randint(1, cap) for _ in range(rng.randint(0, 60))])
        bins = P.best_fit_decreasing(lengths, cap)
        assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
        sums = sorted(int(lengths[b].sum()) for b in bins)
        assert not sums or sums[-1] <= cap
        assert len(sums) == len(scan_best_fit(lengths.tolist(), cap))


@pytest.mark.skipif(not os.path.exists(P.VOCABULARY), reason="vocabulary file is not installed")
def test_packed_documents_round_trip(make_docs):
    rng = random.Random(8)
    rows = [(i, "".join(rng.choice(["a", "the ", "Zü", "\n", "  ", "　", "9", "“x”"]) for _ in range(rng.randint(0, 120)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "long word " * 3000), (None, "no id")]
    length = 64
    got = P.pack_documents(make_docs(rows, ids=1), length=length, block_tokens=500).collect()
    tokens = P.Tokens(open(P.VOCABULARY, "rb").read())
    parts = defaultdict(dict)
    assert len({r.sequence for r in got}) == len(got)
    for r in got:
        ids, pos = np.frombuffer(r.ids, dtype="<u2"), np.frombuffer(r.position_ids, dtype="<u2")
        assert len(ids) == len(pos) == length and r.cu_seqlens[-1] == r.n_tokens <= length
        assert (ids[r.n_tokens:] == tokens.end).all() and len(r.cu_seqlens) == r.n_segments + 1
        for k, (a, b) in enumerate(zip(r.cu_seqlens, r.cu_seqlens[1:])):
            assert pos[a:b].tolist() == list(range(b - a))
            parts[r.doc_ids[k]][r.pieces[k]] = ids[a:b].tolist()
    assert len(parts) == len(rows)
    for i, text in rows:
        whole = [t for _, p in sorted(parts[i].items()) for t in p]
        assert whole[-1] == tokens.end and tokens.decode(whole[:-1]) == (text or "")
    assert P.pack_documents(make_docs([])).count() == 0
    with pytest.raises(ValueError):
        P.pack_documents(make_docs([]), length=0)


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def test_audit_finds_exactly_the_changed_records(spark):
    rows = [(i, f"http://h/{i}", f"<p>{i}</p>" * (i % 9)) for i in range(300)] + [(None, None, None), (5, "http://h/5", "again")]
    bad = {17, 170, 299}
    other = [(i, u, ("X" + h[1:] if i in bad and h else h)) for i, u, h in rows]
    bad = {i for i in bad if i % 9}
    make = lambda r: X.warc_records(pages(spark, r), 32)
    assert X.audit(make(rows), make(rows), 4).count() == 0
    got = X.audit(make(rows), make(other), 4).collect()
    assert {r.page_id for r in got} == bad and all(r.expected_sha256 != r.actual_sha256 for r in got)
    whole = {(r.archive, r.ordinal): r for r in make(rows).collect()}
    assert all(whole[r.archive, r.ordinal].record_offset == r.record_offset for r in got)
    # a cut record shifts what follows it, which is no fault of the others
    cut = [(i, u, h[:-1] if i == 40 else h) for i, u, h in rows]
    assert [(r.page_id, r.fault) for r in X.audit(make(rows), make(cut), 4).collect()] == [(40, "changed")]


def test_missing_records_and_empty_replicas(spark):
    rows = [(i, "u", str(i)) for i in range(20)]
    one, two = X.warc_records(pages(spark, rows), 8), X.warc_records(pages(spark, rows[:17]), 8)
    got = X.audit(one, two, 4).collect()
    assert {r.page_id for r in got} == {17, 18, 19} and all(r.actual_sha256 is None and r.fault == "missing" for r in got)
    none = X.warc_records(pages(spark, []), 8)
    assert X.audit(none, none).count() == 0 and X.audit(one, none).count() == 20 and X.audit(none, one).count() == 20


@pytest.mark.parametrize("at", [0, 5, 199])
def test_one_missing_record_of_two_hundred_is_one_row(spark, at):
    rows = [(i, f"u{i}", f"text {i}") for i in range(200)]
    less = [r for r in rows if r[0] != at]
    make = lambda r: X.warc_records(pages(spark, r))
    assert [(r.page_id, r.fault, r.ordinal) for r in X.audit(make(rows), make(less), 4).collect()] == [(at, "missing", at)]
    assert [(r.page_id, r.fault, r.ordinal) for r in X.audit(make(less), make(rows), 4).collect()] == [(at, "added", at)]


def test_repeated_versions_and_moved_records(spark):
    rows = [(1, "u", "a")] * 50 + [(1, "u", "b")] * 3 + [(2, "u", "c"), (None, None, None)]
    other = [(1, "u", "a")] * 48 + [(1, "u", "b")] * 3 + [(1, "u", "z"), (2, "u", "c"), (None, None, None)]
    make = lambda r: X.warc_records(pages(spark, r))
    got = X.audit(make(rows), make(other), 4).collect()
    assert sorted((r.page_id, r.fault) for r in got) == [(1, "changed"), (1, "missing")]
    plain = [(i, f"u{i}", "x" * i) for i in range(100)]
    hole = make(plain).withColumn("record_offset", F.col("record_offset") + F.when(F.col("pos") >= 60, 7).otherwise(0))
    assert [(r.page_id, r.fault, r.actual_offset - r.record_offset) for r in X.audit(make(plain), hole, 4).collect()] == [(60, "moved", 7)]


def test_audit_descends_into_differing_branches_only(spark):
    rows = [(i, f"u{i}", f"text {i}") for i in range(3000)]
    bad = [(i, u, "other" if i == 1234 else h) for i, u, h in rows]
    sides = [X.with_leaves(X.warc_records(pages(spark, r)), 4, 4) for r in (rows, bad)]
    levels = [X.merkle_levels(r, F.col("sha256"), 4, 4) for r in sides]
    assert [x.count() for x in levels[0]] == [256, 64, 16, 4, 1]
    assert X.differing_leaves(*levels, 4).count() == 1


def test_long_runs_keep_their_ids():
    with open(P.VOCABULARY, "rb") as f:
        tokens = P.Tokens(f.read())
    # short enough for the plain expression: the same ids with and without the cut
    for run in (" " * 20_000, "\n" * 12_345, " \n\t" * 5_000, "\u3000\xa0" * 7_000, "a" * 20_000, "!" * 20_000, " " * 9_999 + "\n"):
        for text in (run, run + "word", "word" + run, "x" + run + "y " + run + "'s", run + "\x1c" + run, "a " + run[:-1] + "\n7", run + "\n!"):
            assert tokens.encode(text) == tokens.encoding.encode_ordinary(text)
    for n in (10 ** 6, 10 ** 7):
        for c in (" ", "\n", "a", "!"):
            text = "start" + c * n + "end"
            assert tokens.decode(tokens.encode(text)) == text


def test_a_text_of_spaces_is_packed(make_docs):
    rows = [(1, " " * 1_200_000 + "x"), (2, "word"), (3, " " * 1_100_000)]
    packed = P.pack_documents(make_docs(rows)).agg(F.sum("n_tokens").alias("n")).first()
    with open(P.VOCABULARY, "rb") as f:
        tokens = P.Tokens(f.read())
    assert packed.n == sum(len(tokens.encode(t)) + 1 for _, t in rows)
