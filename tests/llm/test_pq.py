"""Exact products, and quantisation against Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from callweave.llm import pq

SCHEMA = "vec_id long, embedding array<float>, label int, q string, dim string"


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 9), st.integers(1, 60), st.integers(0, 2 ** 32 - 1))
def test_products_modulo_two_to_64(inner, size, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(-(2 ** size), 2 ** size, (5, inner))
    c = rng.integers(-(2 ** size), 2 ** size, (3, inner))
    want = [[sum(int(a) * int(b) for a, b in zip(r, e)) for e in c] for r in x]
    for bits in (pq.limb_bits(inner), 5):
        got = pq.exact_products(x, c, bits)
        assert [[int(v) % 2 ** 64 for v in r] for r in got] == [[v % 2 ** 64 for v in r] for r in want]


def test_limbs_keep_products_exact():
    for inner in (1, 7, 8, 64, 1000):
        assert inner * (2 ** pq.limb_bits(inner)) ** 2 <= 2 ** 53
    x = np.array([[2 ** 45 + 3, -(2 ** 44) - 1]])
    at, far = pq.nearest(x, x + np.array([[1, 2], [0, 1], [0, -1]])[:, None, :].reshape(3, 2))
    assert at.tolist() == [1] and far.tolist() == [1]


def brute(rows, parts=8, entries=16, rounds=6):
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    w = len(kept[0][1]) // parts
    books = [[r[1][p * w:(p + 1) * w] for r in kept[:entries]] for p in range(parts)]

    def assign(v, p):
        d = [sum((a - b) ** 2 for a, b in zip(v[p * w:(p + 1) * w], e)) for e in books[p]]
        return min((x, i) for i, x in enumerate(d))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, v, _ in kept:
                groups.setdefault(assign(v, p)[1], []).append(v[p * w:(p + 1) * w])
            for e, vs in groups.items():
                books[p][e] = [sum(c) // len(vs) for c in zip(*vs)]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out, per = [], {}
    for i, v, label in kept:
        got = [assign(v, p) for p in range(parts)]
        error = sum(d for d, _ in got)
        per[label] = per.get(label, 0) + error
        out.append((i, label, "".join(f"{e:02x}" for _, e in got), error))
    return [(i, label, code, error, per[label], digest) for i, label, code, error in out]


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(3)


def f32(x):
    return float(np.float32(x))


def random_rows(seed, n, dim):
    rnd = random.Random(seed)
    rows = [(i, [f32(rnd.choice([rnd.gauss(0, 1), 0.0, 100.5])) for _ in range(dim)], rnd.choice([1, 1, 2, None])) for i in range(n)]
    rows += [rows[3]] * 40                                            # repeated rows
    rows += [(4, [f32(rnd.gauss(0, 1)) for _ in range(dim)], 2), (None, [0.5] * dim, None), (None, [-0.5] * dim, 1)]
    rows += [(1, None, 1), (2, [None] * dim, 1), (-5, [float("nan")] * dim, 1), (-6, [float("inf")] * dim, 2)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("n,dim", [(120, 16), (9, 8), (60, 24)])
def test_against_integers(spark, n, dim):
    rows = random_rows(n, n, dim)
    got = [tuple(r) for r in pq.quantise(table(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def test_large_offsets_stay_exact(spark):
    rnd = random.Random(2)
    rows = [(i, [f32(2.0 ** 30 + 512.0 * rnd.randrange(50)) for _ in range(8)], 1) for i in range(50)]
    got = [tuple(r) for r in pq.quantise(table(spark, rows)).collect()]
    assert sorted(got) == sorted(brute(rows))


def test_edges(spark):
    assert pq.quantise(table(spark, []), ).count() == 0
    assert pq.quantise(table(spark, [(1, None, 1)])).count() == 0
    got = pq.quantise(table(spark, [(1, [], 1), (2, [], None)])).collect()
    assert sorted((r["vec_id"], r["code"], r["error"]) for r in got) == [(1, "00" * 8, 0), (2, "00" * 8, 0)]
    with pytest.raises(ValueError):
        pq.quantise(table(spark, [(1, [1.0] * 8, 1), (2, [1.0] * 16, 1)]))
