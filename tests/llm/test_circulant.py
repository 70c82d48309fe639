import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest

from callweave.llm import circulant as C
from callweave.llm import components
from callweave.llm.components import connected_components

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if len(w) >= width:
        return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}
    return {tuple(w)} if w else set()


def brute(rows, width=3, percent=85):
    sets = {i: shingles(t, width) for i, t, *_ in rows if i is not None}
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 5)))
    rows, n = [], 0
    for _ in range(12):
        base = [word() for _ in range(rng.randint(30, 400))]
        for _ in range(rng.randint(1, 9)):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 40))):
                w[rng.randrange(len(w))] = word()
            rows.append((n, " ".join(w)))
            n += 1
    rows += [(n + i, rows[0][1]) for i in range(25)]  # a group of exact copies
    return rows


def test_classes_equal_brute_force(make_docs):
    rows = corpus() + [(900, ""), (901, None), (902, "one two"), (903, "ONE  Two"), (904, "one"), (905, " \t\n"),
                       (906, "x " * 30000)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in C.near_duplicate_classes(make_docs(rows, id=7)).collect()}
    assert got == brute(rows)


def edited(rng, words, word):
    """A copy with scattered edits, or with a block added or left out (0.7 to 0.95 alike)."""
    w, kind = list(words), rng.randrange(3)
    size = rng.randint(len(w) // 20, len(w) // 4)
    at = rng.randrange(len(w) - size)
    if kind == 0:
        w[at:at + size] = []
    elif kind == 1:
        w[at:at] = [word() for _ in range(size)]
    else:
        for _ in range(rng.randint(1, max(1, len(w) // 30))):
            w[rng.randrange(len(w))] = word()
    return w


def test_five_words_and_four_fifths_equal_brute_force(make_docs):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 5)))
    rows = []
    for _ in range(25):
        base = [word() for _ in range(rng.randint(40, 200))]
        rows += [(len(rows) + k, " ".join(w)) for k, w in enumerate([base] + [edited(rng, base, word) for _ in range(4)])]
    rows += [(900, "one two three four"), (901, "One two THREE four"), (902, "one two three"), (903, ""), (904, None)]
    want = brute(rows, 5, 80)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in C.near_duplicate_classes(make_docs(rows), C.FIVE_WORDS).collect()}
    assert got == want and got != brute(rows, 5, 85) and got != {**brute(rows, 3, 85)}
    assert {r.doc_id for r in C.deduplicate(make_docs(rows)).collect()} == {i for i, (_, c) in want.items() if c == i}


def test_bands_and_filters_follow_from_the_threshold():
    assert (C.CLASSES.bands, C.CLASSES.coordinates, C.CLASSES.min_equal, C.CLASSES.max_differing) == (20, 80, 46, 213)
    assert (C.FIVE_WORDS.bands, C.FIVE_WORDS.min_equal, C.FIVE_WORDS.max_differing) == (28, 60, 272)
    assert C.Rule(1, 100).bands == 1
    with pytest.raises(ValueError):
        C.Rule(0, 85)


def test_chain_of_links_and_star_centre_do_not_lose_a_link(make_docs):
    # 1..40 drift away word by word: neighbours are linked, ends are not
    base = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(40):
        rows.append((100 - k, " ".join(base)))
        base[3 * k % 120] = f"n{k}"
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in C.near_duplicate_classes(make_docs(rows)).collect()}
    assert got == brute(rows)


def test_empty_table_null_ids_and_repeated_rows(make_docs):
    assert C.near_duplicate_classes(make_docs([])).count() == 0
    rows = [(None, "a b c d"), (1, "a b c d"), (1, "a b c d"), (2, "a b c d")]
    got = sorted((str(r.doc_id), str(r.component_id)) for r in C.near_duplicate_classes(make_docs(rows)).collect())
    assert got == [("1", "1"), ("1", "1"), ("2", "1"), ("None", "None")]
    kept = C.deduplicate(make_docs(rows))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "None"]
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def linked(x, y, percent=85):
    return x and y and 100 * len(x & y) >= percent * len(x | y)


def brute_rows(rows):
    """component of each row, where one doc_id may hold several texts."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, (a, _) in enumerate(rows):
        for j in range(i):
            if a is not None and rows[j][0] is not None and sets[i] and sets[j] and (linked(sets[i], sets[j]) or a == rows[j][0]):
                up[root(i)] = root(j)
    out = []
    for i, (a, _) in enumerate(rows):
        same = [r[0] for j, r in enumerate(rows) if root(j) == root(i)]
        out.append((a, len(sets[i]), a if a is None or not sets[i] else min(same)))
    return out


def test_one_id_with_several_texts(make_docs):
    rng = random.Random(4)
    texts = [" ".join(f"{c}{rng.randrange(50)}" for _ in range(60)) for c in "abcdef"]
    rows = [(1, texts[0]), (1, texts[1]), (2, texts[0]), (3, texts[1]), (4, texts[2]), (4, texts[0]), (5, texts[3]), (6, texts[3]),
            (6, texts[4]), (7, texts[4] + " more"), (8, texts[5]), (8, texts[5]), (8, ""), (8, None), (None, texts[5]), (9, "")]
    got = C.near_duplicate_classes(make_docs(rows, node=1, rep=2)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_rows(rows)))
    kept = C.deduplicate(make_docs(rows, node=1, k1=2, _dedupe_k1=3))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "node", "k1", "_dedupe_k1"]
    left = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    want = [(1, texts[0]), (1, texts[1]), (4, texts[2]), (5, texts[3]), (6, texts[4]), (8, texts[5]), (8, ""), (8, None),
            (None, texts[5]), (9, "")]
    assert left == sorted(want, key=str)


def test_random_ids_and_copied_sets(make_docs, monkeypatch):
    from callweave.llm import common
    monkeypatch.setattr(common, "HOT_KEYS", 8)
    monkeypatch.setattr(C, "PAIRS_PER_COPY", 4)          # a centre's set is copied
    rng = random.Random(11)
    rows = [(rng.randrange(90), t) for _, t in corpus(5)]
    got = C.near_duplicate_classes(make_docs(rows)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_rows(rows)))


def test_pairs_of_a_hot_centre_are_spread(spark, monkeypatch):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        monkeypatch.setattr(C, "PAIRS_PER_COPY", 50)
        sets = spark.createDataFrame([(i, np.arange(20, dtype=np.uint64).tobytes()) for i in range(2001)], "id long, members binary")
        pairs = spark.createDataFrame([(0, i) for i in range(1, 2001)], "a long, b long")
        assert C.confirmed(pairs, sets).count() == 2000
        counts = pairs.groupBy("a").count().first()["count"]
        assert counts == 2000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_signature_is_circulant_and_estimates_jaccard():
    rng = np.random.default_rng(3)
    common = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
    a = np.concatenate([common, rng.integers(0, 1 << 63, 50, dtype=np.uint64)])
    b = np.concatenate([common, rng.integers(0, 1 << 63, 50, dtype=np.uint64)])
    sig = C.circulant_signature(np.concatenate([a, b]), np.array([0, len(a)]), 400)
    assert abs((sig[0] == sig[1]).mean() - 0.9) < 0.06
    # shifting sigma by one shifts the coordinates by one
    up = C.circulant_signature(a + np.uint64(1 << 32), np.array([0]), 10)
    assert (up[0, 1:] == sig[0, :9]).all()


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(200, x) for x in range(201, 240)] + [(7, 7), (300, 299), (300, 299)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 1 for i in range(1, 61)) and all(got[i] == 200 for i in range(200, 240)) and got[300] == 299
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_are_not_written_again_once_they_are_stars(spark, monkeypatch):
    written = []
    real = components.materialize
    monkeypatch.setattr(components, "materialize", lambda df, name: written.append(name) or real(df, name))
    edges = [(i, i + 100) for i in range(10)] + [(20, 21), (20, 22), (22, 20)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: i for i in range(10)}, **{i + 100: i for i in range(10)}, 20: 20, 21: 20, 22: 20}
    assert len(written) == 1


def test_a_large_open_bucket_is_compared_in_blocks(make_docs, monkeypatch):
    """Drafts of one text, each three words on from the last: most pairs miss the threshold, and no centre links all."""
    rows = [(n, " ".join([f"x{i}" for i in range(3 * n)] + [f"w{i}" for i in range(3 * n, 120)])) for n in range(40)]
    rows += [(100 + n, " ".join([f"z{i}" for i in range(9 * n)] + [f"w{i}" for i in range(9 * n, 120)])) for n in range(1, 9)]
    monkeypatch.setattr(C, "BLOCK", 7)
    monkeypatch.setattr(C, "PAIRS_AT_ONCE", 50)
    groups = []
    real = C._block_rows
    monkeypatch.setattr(C, "_block_rows", lambda members: groups.append(real(members)) or groups[0])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in C.near_duplicate_classes(make_docs(rows, id=7)).collect()}
    assert got == brute(rows)
    sizes = [r["count"] for r in groups[0].groupBy("key", "i", "j").count().collect()]
    assert len(sizes) > 50 and max(sizes) <= 30


def bucket_rows(count, rule=C.CLASSES, blocks=3, seed=3):
    """Rows of one bucket as ``_near_pairs`` takes them, and its members: (id, n, comp, bands, bits)."""
    rng = np.random.default_rng(seed)
    bits = rng.integers(0, 2, C.LONG).astype(np.uint8)
    members = []
    for k in range(count):
        own = bits ^ (rng.random(C.LONG) < 0.058).astype(np.uint8)
        members.append((k, int(rng.integers(90, 111)), int(rng.integers(0, count // 2)), [int(x) for x in rng.integers(0, 4, rule.bands)],
                        np.packbits(own).view(np.int64)))
    for m in members:
        m[3][5] = 77
    rows = []
    for i in range(blocks):
        for j in range(i, blocks):
            rows += [(1, i, j, int(m[0] % blocks == j and j != i), 5, *m) for m in members if m[0] % blocks in (i, j)]
    rows.sort(key=lambda r: r[:4])
    names = ["key", "i", "j", "side", "band", "id", "n", "comp", "bands", "bits"]
    return pa.RecordBatch.from_arrays([pa.array([r[c] if c < 9 else list(r[c]) for r in rows]) for c in range(10)], names=names), members


@pytest.mark.parametrize("step", [1, 7, 1000])
def test_pairs_of_blocks_are_the_pairs_of_the_bucket(step, monkeypatch):
    monkeypatch.setattr(C, "PAIRS_AT_ONCE", 64)
    rows, members = bucket_rows(40)
    batches = [rows.slice(lo, step) for lo in range(0, rows.num_rows, step)]
    got = [(a, b) for out in C._near_pairs(C.CLASSES)(batches) for a, b in zip(*(c.to_pylist() for c in out.columns))]
    want = [(p[0], q[0]) for p in members for q in members if p[0] < q[0] and p[2] != q[2]
            and 100 * min(p[1], q[1]) >= 85 * max(p[1], q[1]) and not any(p[3][i] == q[3][i] for i in range(5))
            and sum(bin(int(x) ^ int(y)).count("1") for x, y in zip(p[4].view(np.uint64), q[4].view(np.uint64))) <= C.CLASSES.max_differing]
    assert 0 < len(want) < 40 * 39 // 2 and sorted(got) == want


def test_pairs_of_a_bucket_cost_microseconds():
    rows, _ = bucket_rows(1500, blocks=1)
    start = time.process_time()
    pairs = sum(out.num_rows for out in C._near_pairs(C.CLASSES)([rows]))
    # about a million pairs; inside the join each took some 30 microseconds
    assert pairs > 10000 and time.process_time() - start < 10
