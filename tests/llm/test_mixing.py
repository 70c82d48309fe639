import random

import pytest

from callweave.llm import mixing as M


def shared_by_weight(sizes, weights, total, repeats=3):
    """Targets by the rule's own words: share, stop those above, share the excess again."""
    target, free, rest = dict.fromkeys(sizes, 0.0), list(sizes), float(total)
    while free:
        scale = rest / sum(weights[s] for s in free)
        full = [s for s in free if weights[s] * scale > repeats * sizes[s]]
        for s in full or free:
            target[s] = float(repeats * sizes[s]) if full else weights[s] * scale
        rest -= sum(target[s] for s in full)
        free = [s for s in free if s not in full] if full else []
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets_stop_at_the_cap_and_share_the_excess(spark, seed):
    rng = random.Random(seed)
    names = ["b", None, "a", "Z", "é", "", "\U0001d11e", "\uffee"][:rng.randint(2, 8)]
    sizes = {n: rng.choice([0, 1, 10, 100, 5000]) for n in names}
    rows = spark.createDataFrame([(n, [s]) for s, n in sizes.items()], "size long, sources array<string>")
    order = sorted((n for n in names if n is not None)) + [None] * (None in names)
    got = {r.source: (r.idx, r.target, r.source_size) for r in M.source_targets(rows, None, 1.0, 3).collect()}
    want = shared_by_weight(sizes, {s: M.WEIGHTS[i % 3] for i, s in enumerate(order)}, sum(sizes.values()))
    assert {s: got[s][0] for s in names} == {s: i for i, s in enumerate(order)}
    assert all(abs(got[s][1] - want[s]) < 1e-6 and got[s][2] == sizes[s] for s in names)


def least_cost(patterns, quotas, repeats=3):
    """(most tokens that can be routed, their least cost) by trying every amount."""
    best = (-1, 0)

    def go(i, left, moved, cost):
        nonlocal best
        if i == len(patterns):
            best = max(best, (moved, -cost))
            return
        sources, tokens = patterns[i]

        def deal(j, used, left):
            if j == len(sources):
                full, rest = divmod(used, tokens) if tokens else (0, 0)
                go(i + 1, left, moved + used, cost + tokens * full * (full - 1) // 2 + rest * full)
                return
            for x in range(min(left[sources[j]], repeats * tokens - used) + 1):
                deal(j + 1, used + x, {**left, sources[j]: left[sources[j]] - x})
        deal(0, 0, left)

    go(0, dict(quotas), 0, 0)
    return best[0], -best[1]


@pytest.mark.parametrize("seed", range(12))
def test_flow_against_every_amount(seed):
    rng = random.Random(seed)
    names = ["a", "b", None]
    patterns = list({tuple(n for n in names if rng.random() < 0.6) or ("a",): rng.randint(1, 2) for _ in range(3)}.items())
    quotas = {n: rng.randint(0, 5) for n in names}
    got = M.route(patterns, quotas)
    moved = sum(n for f in got for _, n in f)
    cost = 0
    for f, (_, tokens) in zip(got, patterns):
        full, rest = divmod(sum(n for _, n in f), tokens)
        cost += tokens * full * (full - 1) // 2 + rest * full
    assert (moved, cost) == least_cost(patterns, quotas)
    assert all(sum(n for f in got for s, n in f if s == name) <= quotas[name] for name in names)


def test_twenty_thousand_sources(spark):
    rows = spark.range(20_000).selectExpr("id AS doc_id", "10 + id % 3 AS size", "array(concat('s', id)) AS sources", "id AS _row")
    got, sources = M.mix(rows)
    assert got.count() == 20_000 and sources.count() == 20_000
    miss = got.join(sources, got["sources"][0] == sources["source"]).filter("target - taken >= size AND taken < 3 * size OR taken > target + 1")
    assert miss.isEmpty()


def test_components_of_overlapping_patterns_are_solved_apart(spark):
    rng = random.Random(8)
    sets = [["a", "b"], ["a"], ["c", "d", None], [None], ["d"], ["e"], ["f"]]
    rows = [(i, rng.randint(1, 9), rng.choice(sets), i) for i in range(300)]
    got, sources = M.mix(spark.createDataFrame(rows, "doc_id long, size long, sources array<string>, _row long"))
    quota = {r.source: round(r.target) for r in sources.collect()}
    tokens = {}
    for _, n, s, _ in rows:
        key = tuple(sorted(s, key=lambda x: (x is None, x or "")))
        tokens[key] = tokens.get(key, 0) + n
    whole = M.route(sorted(tokens.items(), key=lambda p: [(s is None, s or "") for s in p[0]]), quota)
    taken = sum(r.taken for r in got.collect())
    assert 0 <= sum(n for f in whole for _, n in f) - taken < len(tokens)


def test_flow_meets_quotas_with_the_fewest_repetitions():
    patterns = [(("a",), 10), (("a", "b"), 10), (("b",), 5)]
    got = M.route(patterns, {"a": 12, "b": 13})
    assert sum(n for f in got for s, n in f if s == "a") == 12 and sum(n for f in got for s, n in f if s == "b") == 13
    assert all(sum(n for _, n in f) <= size for f, (_, size) in zip(got, patterns))  # nothing is taken twice
    twice = M.route([(("a",), 10)], {"a": 25})
    assert twice == [[("a", 25)]]


def test_documents_reach_their_targets_and_reruns_agree(make_docs):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randint(1, 60), rng.choice(["a", "b", "c", "d", None])) for i in range(400)]
    rows += [(1000 + i, "hot " * 40, "a") for i in range(300)] + [(2000, None, "b"), (2001, "", "c"), (2002, " \n", None),
                                                                   (None, "x y", "d"), (3, "w w", "a"), (3, "w w", "a")]
    docs = make_docs(rows, size=4, taken=1)
    one, two = M.mixed_documents(docs).collect(), M.mixed_documents(docs.repartition(7)).collect()
    key = lambda rs: sorted(((r.doc_id or -1, r.size, r.taken, r.target) for r in rs))
    assert key(one) == key(two) and len(one) == len(rows)
    sizes = {r.doc_id: r.size for r in one}
    assert sizes[2000] == sizes[2001] == sizes[2002] == 0
    taken, target = {}, {}
    by_target = {}
    for r in one:
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        by_target.setdefault((r.source_size, r.target), []).append(r)
    assert len(by_target) == 5
    for (n, t), rs in by_target.items():
        assert sum(r.size for r in rs) == n and abs(sum(r.taken for r in rs) - t) <= max(2, 0.01 * t)


def test_overlapping_sources_share_a_pattern(spark):
    rows = spark.createDataFrame([(i, 10, ["a", "b"] if i % 2 else ["a"], i) for i in range(40)] + [(90, 10, [], 90), (91, 5, None, 91)],
                                 "doc_id long, size long, sources array<string>, _row long")
    got, sources = M.mix(rows, {"a": 1.0, "b": 1.0})
    got = {r.doc_id: r for r in got.collect()}
    target = {r.source: r.target for r in sources.collect()}
    assert target == {"a": 200.0, "b": 200.0}
    routed = [s for r in got.values() for s in (r.routes or [])]
    assert abs(routed.count("a") * 10 - 200) <= 10 and abs(routed.count("b") * 10 - 200) <= 10
    assert got[90].taken == 0 and got[91].taken == 0
    assert all(s in r.sources for r in got.values() for s in (r.routes or []))


def test_empty_tables(make_docs):
    assert M.mixed_documents(make_docs([])).count() == 0
    assert M.apply_mix(make_docs([])).count() == 0


def test_apply_mix_repeats_rows_and_keeps_columns(make_docs):
    docs = make_docs([(1, "a b c", "x"), (2, "a", "y"), (3, "", "x")], _row=-7, _times=9, row="r", _pos=1)
    out = M.apply_mix(docs)
    assert out.columns == docs.columns and 3 not in {r.doc_id for r in out.collect()}
    assert {(r._row, r._times, r.row, r._pos) for r in out.collect()} == {(-7, 9, "r", 1)}


@pytest.mark.parametrize("seed", [6, 27])
def test_a_long_document_across_the_end_leaves_no_gap_that_documents_fit(spark, seed):
    rows = spark.createDataFrame([(0, 20_000, ["a"], 0)] + [(i, 20, ["a"], i) for i in range(1, 2001)],
                                 "doc_id long, size long, sources array<string>, _row long")
    got, sources = M.mix(rows, {"a": 1.0}, share=0.5, seed=seed)
    assert sources.first().target == 30_000
    got = got.collect()
    assert len(got) == 2001 and 0 <= 30_000 - sum(r.taken for r in got) < 20
    assert max(r.times for r in got) == 1


def test_filling_repeats_short_documents_when_nothing_else_fits(spark):
    sizes = [5000] + [1 + i % 7 for i in range(300)]
    rows = spark.createDataFrame([(i, n, ["a", None] if i % 2 else ["a"], i) for i, n in enumerate(sizes)],
                                 "doc_id long, size long, sources array<string>, _row long")
    for share in (0.3, 0.9):
        got, sources = M.mix(rows, {"a": 1.0, None: 1.0}, share=share)
        got, target = got.collect(), sum(round(r.target) for r in sources.collect())
        quota = min(target, 3 * sum(sizes))
        open_ = [min((r.size for r in got if r.times < 3 and len(r.sources) == k), default=1) for k in (1, 2)]
        assert len(got) == len(sizes) and all(len(r.routes or []) == r.times <= 3 for r in got)
        assert 0 <= quota - sum(r.taken for r in got) < sum(open_)  # each pattern misses less than one document


def test_apply_mix_takes_a_share_of_identical_rows(make_docs):
    rows = [(i, "w " * 20, "a") for i in range(10)] + [(None, "x y z w", "b")] * 50
    docs = make_docs(rows)
    plan = M.mixed_documents(docs).collect()
    assert {r.times for r in plan if r.doc_id is None} == {0, 1}
    got = M.apply_mix(docs).collect()
    target = 400 * 2 / 7
    assert sum(r.text == "x y z w" for r in got) * 4 == sum(r.taken for r in plan if r.doc_id is None)
    assert 0 <= target - 4 * sum(r.text == "x y z w" for r in got) < 5
    assert sum(20 for r in got if r.source == "a") == sum(r.taken for r in plan if r.doc_id is not None)
