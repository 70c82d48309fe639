import hashlib
import random
import re

from callweave.llm import decontam as D

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall((t or "").translate(LOW))


def brute(docs, items, window=13):
    wins = {}
    for item, text in items:
        w = words(text)
        m = min(window, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            wins.setdefault(tuple(w[i:i + m]), set()).add(str(item))
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for m in {len(k) for k in wins}:
            for i in range(len(w) - m + 1):
                got = wins.get(tuple(w[i:i + m]))
                if got:
                    found |= got
                    hit |= set(range(i, i + m))
        out.append((doc_id, len(w), len(hit), tuple(sorted(found)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in df.collect()), key=repr)


def fixture(seed=5):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(30)] + ["été", "N9", "The"]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(rng.randint(1, 40))) for i in range(12)] + [(50, "..."), (51, None), (52, "solo"), (53, "the the the")]
    docs = []
    for k in range(60):
        parts = [text(rng.randint(0, 80))]
        if k % 3 == 0:
            parts.append(items[k % 12][1].upper() if k % 2 else items[k % 12][1])
        parts.append(text(rng.randint(0, 80)))
        docs.append((k, rng.choice([" ", "\n", "--"]).join(parts)))
    docs += [(100, None), (101, ""), (102, "solo"), (102, "solo"), (103, "the the the the"), (None, "solo end"), (104, "a " * 40000)]
    return docs, items


def test_hits_equal_brute_force(spark, make_docs):
    docs, items = fixture()
    table = spark.createDataFrame(items, "item_id long, text string")
    assert rows_of(D.contamination(make_docs(docs, item_id=3), table)) == brute(docs, items)
    # test items in several blocks give the same rows
    index = D.build_index(make_docs(docs))
    one = D.hit_counts(D.search_phrases(index, table))
    many = D.hit_counts(D.search_phrases(index, table, block_tokens=40))
    key = lambda df: sorted((r.segment, r.ord, r.n_hit, tuple(sorted(r["items"]))) for r in df.collect())
    assert key(one) == key(many)


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert rows_of(D.contamination(make_docs([(1, "a b")]), none)) == [(1, 2, 0, (), False)]
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert D.contamination(make_docs([]), some).count() == 0


def test_decontaminate_keeps_columns_and_judges_rows_that_share_an_id(spark, make_docs):
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    docs = make_docs([(1, "alpha beta gamma"), (1, "clean text"), (None, "x alpha beta gamma"), (2, None)], contaminated=1)
    left = D.decontaminate(docs, items)
    assert left.columns == docs.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in left.collect()) == [("1", "clean text"), ("2", "None")]


def test_near_matches_need_all_terms_within_the_span(spark, make_docs):
    items = spark.createDataFrame([(1, "red fox den")], "item_id long, text string")
    docs = make_docs([(1, "fox x den y red"), (2, "fox a a a a a a a a den red"), (3, "red fox")])
    index = D.build_index(docs)
    hits = D.search_near(index, items, 4).join(D.documents_of(index), ["segment", "ord"])
    assert {r.doc_id for r in hits.collect()} == {1}


def test_items_without_id_are_searched(spark, make_docs):
    items = spark.createDataFrame([(None, "alpha beta gamma"), (None, "one two three"), (2, "beta gamma delta"), (None, None)],
                                  "item_id long, text string")
    docs = make_docs([(1, "x alpha beta gamma delta"), (2, "alpha beta gamma one two three"), (3, "clean text"), (4, "beta gamma delta")])
    found = D.contamination(docs, items)
    assert [r[:1] + r[2:] for r in rows_of(found)] == [(1, 4, ("2", None), True), (2, 6, (None,), True), (3, 0, (), False), (4, 3, ("2",), True)]
    assert {r.doc_id for r in D.decontaminate(docs, items).collect()} == {3}
    index = D.build_index(docs)
    assert D.hit_counts(D.search_phrases(index, items, block_tokens=3)).count() == 3
    assert {r.item_id for r in D.search_near(index, items, 3).collect()} == {None, "2"}


def test_query_counts_items_without_id_as_one(spark, make_docs, tmp_path):
    from callweave.llm.queries import op10_decontamination
    make_docs([(1, "x alpha beta gamma delta"), (2, "alpha beta gamma")]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(None, "alpha beta gamma"), (None, "x alpha"), (2, "beta gamma delta")], "item_id long, text string") \
        .write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: (r.n_hit, r.n_items, r.items_sha256) for r in op10_decontamination(spark, str(tmp_path)).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    # as in the query's SQL: the null is counted once and not in the digest
    assert got == {1: (5, 2, sha("2")), 2: (3, 1, sha(""))}


def brute_near(docs, items, stretch):
    out = []
    for doc_id, text in docs:
        w, found = words(text), set()
        for item, t in items:
            need, span = set(words(t)), stretch * len(words(t))
            if need and any(need <= set(w[e - span + 1 if e >= span else 0:e + 1]) for e in range(len(w))):
                found.add(item)
        out.append((doc_id, len(found)))
    return sorted(out, key=repr)


def test_runs_with_all_words_of_an_item_equal_brute_force(spark, make_docs):
    rng = random.Random(9)
    docs, items = fixture()
    docs = [(i, t) for i, t in docs if len(t or "") < 5000]
    for k in range(80):   # items in another order, with other words between them, or cut in two by the end of a text
        w = words(items[k % 12][1])
        rng.shuffle(w)
        for _ in range(rng.randint(0, 2 * len(w))):
            w.insert(rng.randint(0, len(w)), f"x{rng.randrange(9)}")
        docs.append((1000 + k, " ".join(w)))
    docs += [(2000, "alpha beta"), (2001, "gamma delta")]
    items += [(54, "alpha beta gamma"), (None, "x1 x2"), (None, "x3"), (7, items[3][1])]
    table = spark.createDataFrame(items, "item_id long, text string")
    for stretch in (1, 2):
        got = D.contamination(make_docs(docs), table, stretch=stretch)
        want = brute_near(docs, items, stretch)
        assert sorted(((r.doc_id, r.n_near) for r in got.collect()), key=repr) == want
        assert sum(n for _, n in want) > 50
    none = D.contamination(make_docs([(1, "a"), (2, None)]), table.limit(0), stretch=2)
    assert {r.n_near for r in none.collect()} == {0}
    assert D.contamination(make_docs([]), table, stretch=2).count() == 0


def test_runs_of_common_words_take_linear_time(spark, make_docs):
    import time
    t0 = time.time()
    docs = make_docs([(1, "the of " * 300_000), (2, "the " * 600_000 + "of"), (3, "the " * 600_000)])
    items = spark.createDataFrame([(1, "of the"), (2, "the the the of the"), (3, "of the end")], "item_id long, text string")
    got = {r.doc_id: r.n_near for r in D.contamination(docs, items, stretch=2).collect()}
    assert got == {1: 2, 2: 2, 3: 0} and time.time() - t0 < 60
