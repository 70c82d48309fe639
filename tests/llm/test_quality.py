import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np

from callweave.llm import quality_crf as Q
from callweave.llm import quality_llr as L
from callweave.llm.bytewords import WordHasher, space_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    w = WORD.findall(text or "")
    seen = defaultdict(list)
    for i in range(len(w) - 7):
        seen[tuple(w[i:i + 8])].append(i)
    covered = {p for v in seen.values() if len(v) > 1 for i in v for p in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    row = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))
    return (*row, row[0] < 20 or 100 * row[4] > 30 * row[0])


def texts():
    rng = random.Random(2)
    good = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randint(0, 60)) for _ in range(80)) for _ in range(40)]
    junk = [" ".join(f"zz{rng.randint(0, 9)}###" for _ in range(60)) for _ in range(10)]
    odd = [None, "", " \n\t ", "a b c " * 10, "line one two\nline one two\n\nx", "é#ü " * 5000, "one\x0btwo\x1cthree", "a " * 7, "a " * 8, "a " * 9]
    odd.append("p q r s t u v w " + "x " * 30 + "p q r s t u v w")
    return good + junk + odd


def test_base_counts_equal_brute_force_and_junk_is_not_kept(make_docs):
    rows = list(enumerate(texts())) + [(3, texts()[3]), (None, "null id")]
    got = L.quality_verdicts(make_docs(rows, kept=1, llr="x")).collect()
    want = Counter((i, *base(t)) for i, t in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    kept = {r.doc_id for r in got if r.kept}
    assert set(range(40)) <= kept and not kept & set(range(40, 50)) and not any(r.kept and r.base_failed for r in got)
    assert L.quality_verdicts(make_docs([])).count() == 0


def test_log_ratios_are_the_multinomials(make_docs):
    docs = make_docs(list(enumerate(texts())))
    weights = L.log_ratios(docs)
    assert len(weights) == 2 * L.BUCKETS and max(weights) > 0 > min(weights)
    # without a trusted document both corpora are equal
    assert set(L.log_ratios(make_docs([(1, "a b c")]))) == {0.0}


def test_marginals_equal_the_sum_over_all_labellings():
    rng = np.random.default_rng(1)
    first = np.array([0, 1, 5, 5, 8])
    score, trans = rng.normal(size=8), rng.normal(size=(2, 2))
    got, pair, log_z = Q.marginals(score, first, trans)
    total_z, total_pair = 0.0, np.zeros((2, 2))
    for a, b in zip(first[:-1], first[1:]):
        if a == b:
            continue
        z, good, pairs = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=b - a):
            p = math.exp(sum(score[a + i] * v for i, v in enumerate(y)) + sum(trans[u, v] for u, v in zip(y, y[1:])))
            z += p
            good += p * np.array(y)
            for u, v in zip(y, y[1:]):
                pairs[u, v] += p
        assert np.allclose(got[a:b], good / z)
        total_z += math.log(z)
        total_pair += pairs / z
    assert np.allclose(pair, total_pair) and abs(log_z - total_z) < 1e-9


def test_line_features_do_not_depend_on_the_chunk():
    rows = [(t or "").encode() for t in texts()]
    hasher = WordHasher(space_words())
    whole = Q.line_features(hasher, np.frombuffer(b"".join(rows), dtype=np.uint8), np.cumsum([0] + [len(r) for r in rows]))
    for i, r in enumerate(rows):
        f, size, first = Q.line_features(hasher, np.frombuffer(r, dtype=np.uint8), np.array([0, len(r)]))
        a, b = whole[2][i], whole[2][i + 1]
        assert first[1] == b - a >= 1 and np.allclose(f, whole[0][a:b]) and np.allclose(size, whole[1][a:b])


def test_held_out_accuracy_and_defined_cases(spark, make_docs):
    from tests.llm.conftest import is_held_out
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    clean = lambda: "\n".join(" ".join(word() for _ in range(rng.randint(5, 30))).capitalize() + "." for _ in range(rng.randint(1, 8)))
    junk = lambda: clean().split("\n")[0] + "\n" + " ".join([word().upper() + "!!"] * 3 + [word() + "###" for _ in range(60)])
    rows = [(i, junk() if i % 4 == 0 else clean()) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(400)] + [(None, 1, 0), (7, None, 0)],
                                   "doc_id long, quality int, toxic int")
    model = Q.train(make_docs(rows), labels)
    extra = [(900, None), (901, ""), (902, "\n\n"), (None, "Word."), (0, rows[0][1])]
    docs = make_docs(rows + extra, quality=3)
    got = Q.score_quality(docs, model)
    assert got.columns == [*docs.columns, "quality_score"]
    scores = {r.doc_id: r.quality_score for r in got.collect()}
    held = [i for i in range(400) if is_held_out(i)]
    assert sum((scores[i] >= 0.3) == (i % 4 != 0) for i in held) >= 0.97 * len(held)
    assert all(0 <= s <= 1 for s in scores.values()) and len(scores) == 404
    none = spark.createDataFrame([], labels.schema)
    assert {r.quality_score for r in Q.score_quality(docs, Q.train(docs, none)).collect()} == {0.5}
    assert Q.score_quality(make_docs([]), model).count() == 0
    assert Q.keep_good(docs, labels).columns == docs.columns
