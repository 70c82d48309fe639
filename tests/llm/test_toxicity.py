import random

import numpy as np

from callweave.llm import toxicity as X


def reader():
    return X.ToxicModel({w + "$": 1.0 for w in X.INSULTS} | {"blorg": 1.0}, X.DEFAULT_LAYER).reader()


def outcomes(text):
    r = reader()
    state, out = 0, []
    for w in X._WORD.findall(text.lower()):
        state, symbol, _ = r.machine.step(state, r.symbol(w)[0])
        out.append(symbol)
    return "".join(out)


def test_composed_machine_rewrites_insults_by_context():
    assert outcomes("what an idiot") == "OOI"
    assert outcomes("you are an idiot") == "YOOJ"
    assert outcomes("he is not an idiot") == "YONOn"
    assert outcomes("she said that idiot left") == "YROrO"
    assert outcomes("“ idiot ” he wrote") == "QrQYR"
    assert outcomes("i will kill you") == "OOTY" and outcomes("you they will kill") == "YYOK"


def test_composition_equals_running_the_parts_in_turn():
    rng = random.Random(1)
    parts = [X.scope("N", {"I": ("n", -1.0)}, 3), X.scope("R", {"I": ("r", -0.5)}, None), X.scope("Y", {"I": ("J", 0.5)}, 4)]
    whole = X.compose(X.compose(parts[0], parts[1], X.ALPHABET), parts[2], X.ALPHABET)
    for _ in range(300):
        states, state = [0, 0, 0], 0
        for symbol in (rng.choice(X.ALPHABET) for _ in range(20)):
            s, w = symbol, 0.0
            for k, p in enumerate(parts):
                states[k], s, v = p.step(states[k], s)
                w += v
            state, out, weight = whole.step(state, symbol)
            assert out == s and abs(weight - w) < 1e-12


def test_clauses_scores_and_stems():
    r = reader()
    assert list(r.clauses("fine here. an idiot, idiot spoke! end; notblorg. blorgish one")) == [" an idiot, idiot spoke!", " blorgish one"]
    assert r.score("you idiot") > 0.5 > r.score("he is not an idiot") and r.score(None) == r.score("") < 0.1
    assert r.features("x" * 200000 + " idiot " * 20000)[2] > 9
    assert all(r.score(t) < 0.5 for t in ("idiot", "the idiot box", "an idiot sat there", "a murder", "he is not a moron",
                                          "she said that clown is late"))
    assert all(r.score(t) > 0.5 for t in ("you idiot", "they are scum", "you they will kill"))
    counts = {"vequ": (40, 0), "vequa": (15, 0), "moro": (30, 0), "moron": (30, 0), "moron$": (30, 0), "the$": (100, 900), "rare": (2, 0)}
    assert set(X.choose_stems(counts, 100, 900)) == {"vequ", "moron$"}


def test_training_held_out_and_defined_cases(spark, make_docs):
    from tests.llm.conftest import is_held_out
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 7)))

    def text(toxic):
        w = [word() for _ in range(60)]
        if toxic:
            for _ in range(4):
                w[rng.randrange(60)] = rng.choice(["zorky", "idiot"]) + rng.choice(["", "ab", "en"])
        return " ".join(w) + "."

    rows = [(i, text(i % 5 == 1)) for i in range(500)]
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 1)) for i in range(500)] + [(None, 1, 1), (9, 1, None)],
                                   "doc_id long, quality int, toxic int")
    model = X.train(make_docs(rows), labels)
    assert any(s.startswith("zork") for s in model.stems)
    docs = make_docs(rows + [(900, None), (901, ""), (None, "you idiot"), (1, rows[1][1])], toxic=0)
    got = X.score_toxicity(docs, model)
    assert got.columns == [*docs.columns, "toxic_score"] and got.count() == 504
    scores = {r.doc_id: r.toxic_score for r in got.collect()}
    held = [i for i in range(500) if is_held_out(i)]
    assert np.mean([(scores[i] >= 0.5) == (i % 5 == 1) for i in held]) >= 0.97
    assert scores[900] == scores[901] < 0.5
    none = X.train(docs, spark.createDataFrame([], labels.schema))
    assert X.score_toxicity(make_docs([(1, "you idiot"), (2, "hello")]), none).filter("toxic_score >= 0.5").count() == 1
    assert X.score_toxicity(make_docs([]), none).count() == 0


def score_of(text, stems, layer):
    """A document's score by the definition: clauses cut at their signs, transducers run one after the other."""
    import math
    import re
    parts = [X.scope("N", {"I": ("n", -1.0), "T": ("n", -1.0)}, 3), X.scope("R", {"I": ("r", -0.5), "T": ("r", -0.5)}, None),
             X.Transducer({(0, "Q"): (1, "Q", 0.0), (1, "Q"): (0, "Q", 0.0), (1, "I"): (1, "r", -0.5), (1, "T"): (1, "r", -0.5)}),
             X.scope("Y", {"I": ("J", 0.5), "T": ("K", 1.0)}, 4)]
    total = dict.fromkeys("ITJKnr", 0.0)
    kinds = [("Y", X.TARGETS), ("N", X.NEGATIONS), ("R", X.REPORTS), ("T", X.THREATS), ("Q", X.QUOTES)]
    for clause in re.split(r"(?<=[.!?;\n])", (text or "").lower()):
        states = [0] * 4
        for word in X._WORD.findall(clause):
            hit = [w for s, w in stems.items() if (word == s[:-1] if s.endswith("$") else word.startswith(s))]
            symbol, strength = ("I", hit[0]) if hit else next(((k, 1.0) for k, words in kinds if word in words), ("O", 1.0))
            weight = 0.0
            for i, p in enumerate(parts):
                states[i], symbol, w = p.step(states[i], symbol)
                weight += w
            if symbol in total:
                total[symbol] += strength * math.exp(weight)
    x = [1.0] + [v for o in "ITJKnr" for v in (min(total[o], 1.0), math.log1p(total[o]))]
    return 1 / (1 + math.exp(-sum(a * b for a, b in zip(x, layer))))


def test_document_scores_against_the_definition():
    rng = random.Random(6)
    model = X.ToxicModel({w + "$": 1.0 for w in X.INSULTS} | {"blorg": 0.5}, X.DEFAULT_LAYER)
    words = ["you", "not", "said", "kill", "idiot", "moron", "blorgish", "the", "house", "“", "”", ".", "!", "\n", ";", "she", "nie"]
    r = model.reader()
    for _ in range(400):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))
        assert abs(r.score(text) - score_of(text, model.stems, model.layer)) < 1e-9, text


def test_time_follows_the_length():
    import time
    r, took = reader(), {}
    for n in (20_000, 200_000):
        text = "you idiot, and no end of it, " * n if n < 0 else "an idiot went on? " * n
        t = time.process_time()
        r.score(text)
        took[n] = time.process_time() - t
    assert took[200_000] < 25 * took[20_000] + 1


def test_labels_decide_about_bare_insults(spark, make_docs):
    rng = random.Random(5)
    fill = lambda: " ".join(rng.choice(["house", "tree", "river", "stone"]) for _ in range(20))
    rows = [(i, f"{fill()}. {'you idiot' if i % 2 else 'an idiot box'}. {fill()}.") for i in range(400)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(400)], "doc_id long, quality int, toxic int")
    r = X.train(make_docs(rows), labels).reader()
    assert r.score("the idiot box") < 0.5 < r.score("you idiot")
