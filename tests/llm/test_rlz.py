"""Relative Lempel-Ziv duplicate spans against every window counted singly."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from callweave.llm import rlz


def brute(rows, width):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for (doc_id, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i:i + width])] > 1:
                gone.update(range(i, i + width))
        out.append((doc_id, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def check(make_docs, rows, width):
    got = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"], r["removed"]) for r in
           rlz.remove_repeats(make_docs(rows, k1=1, copies="x", pos="x"), width).collect()]
    assert sorted(map(str, (g[:4] for g in got))) == sorted(map(str, brute(rows, width)))
    for _, n, removed, _, spans in got:
        flat = [x for s in spans for x in (s["first"], s["end"])]
        assert flat == sorted(flat) and len(set(flat)) == len(flat) and sum(s["end"] - s["first"] for s in spans) == removed
    return got


@pytest.mark.parametrize("seed,letters,width", [(1, 2, 4), (2, 3, 6), (3, 2, 9), (4, 30, 5), (5, 1, 3)])
def test_random_texts(spark, make_docs, seed, letters, width):
    rnd = random.Random(seed)
    rows = [(i, " ".join(rnd.choice("abcdefghijklmnopqrstuvwxyz0123")[:1] if letters > 3 else rnd.choice("abc"[:letters])
                         for _ in range(rnd.choice([0, 2, 5, 12, 25])))) for i in range(60)]
    check(make_docs, rows, width)


def test_shared_passages_and_copies(spark, make_docs, monkeypatch):
    from callweave.llm import common
    monkeypatch.setattr(common, "HOT_KEYS", 4)                      # many keys take the broadcast side
    rnd = random.Random(9)
    fresh = lambda n: [f"w{rnd.randrange(10 ** 9)}" for _ in range(n)]
    passage, boiler = fresh(60), fresh(35)
    rows = []
    for i in range(120):
        body = fresh(rnd.randrange(0, 90))
        if i % 3 == 0:
            body[len(body) // 2:len(body) // 2] = passage[rnd.randrange(0, 20):rnd.randrange(30, 61)]
        if i % 4 == 0:
            body += boiler
        rows.append((i, "\t ".join(body) + ("\n" if i % 2 else "")))
    base = fresh(400)
    for i in range(6):                                                # near copies, one word changed each
        copy = list(base)
        copy[60 * i + 10] = "changed"
        rows.append((200 + i, " ".join(copy)))
    rows += [(300 + i, " ".join(passage)) for i in range(30)]         # exact copies
    rows += [(400, "short text"), (401, "short text"), (402, None), (403, ""), (404, " \n"), (None, " ".join(boiler)), (5, "x")]
    rows += [(500, " ".join(fresh(34))), (501, " ".join(boiler[:34])), (502, "Ä " * 200), (503, " ".join(boiler).upper())]
    got = check(make_docs, rows, 35)
    assert any(r[4] for r in got)


def test_factors_copy_their_source(spark, make_docs):
    rnd = random.Random(3)
    base = [f"w{rnd.randrange(10 ** 9)}" for _ in range(300)]
    rows = [(1, " ".join(base)), (2, " ".join(["x"] + base[20:200] + ["y"] + base[210:]))]
    texts = rlz.distinct_texts(make_docs(rows))
    parsed = rlz.parse_texts(texts).collect()
    words = {r["k1"] & rlz._SOURCE_MASK: (r, dict(rows)[r["doc_id"]].split()) for r in parsed}
    two = next(r for r in parsed if r["doc_id"] == 2)
    mine = dict(rows)[2].split()
    assert two["factors"] and max(f["length"] for f in two["factors"]) > 100
    for f in two["factors"]:
        source = words[f["source"]][1]
        assert f["length"] >= rlz.WIDTH
        assert mine[f["start"]:f["start"] + f["length"]] == source[f["source_start"]:f["source_start"] + f["length"]]


def test_long_texts_in_stretches(monkeypatch):
    rng = np.random.default_rng(1)
    h = rng.integers(0, 50, 4000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    first = np.array([0, 10, 10, 1500, 4000])
    whole = [np.concatenate(c) for c in zip(*rlz.text_anchors(h, first, 12))]
    starts = np.flatnonzero(rng.random(1400) < 0.3)
    hashes = rlz.window_hashes(h, starts, 12)
    monkeypatch.setattr(rlz, "STRETCH", 100)
    cut = [np.concatenate(c) for c in zip(*rlz.text_anchors(h, first, 12))]
    assert all((a == b).all() for a, b in zip(whole, cut))
    assert all((a == b).all() for a, b in zip(hashes, rlz.window_hashes(h, starts, 12)))


def test_empty_table(spark, make_docs):
    assert rlz.remove_repeats(make_docs([(1, "a")]).limit(0)).count() == 0
