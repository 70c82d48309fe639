"""Fill-in-the-middle against string slicing, and the exact way back."""

import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from callweave.llm import fim
from callweave.llm.queries import fim_digests


def by_slicing(doc_id, text):
    text = text or ""
    n = len(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in range(0, 32, 8))
    if n == 0 or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab<PSM>é漢𝄞\n", max_size=40), st.integers(0, 40), st.integers(0, 40), st.sampled_from(["psm", "spm"]))
def test_rotations_restore(text, a, b, form):
    data = text.encode()
    if any(m in text for m in ("<P>", "<S>", "<M>")):
        return
    a, b = sorted((min(a, len(text)), min(b, len(text))))
    cuts = fim.scan_cuts(np.frombuffer(data, dtype=np.uint8), (a, b))
    pre, mid, suf = text[:a], text[a:b], text[b:]
    want = f"<S>{suf}<P>{pre}<M>{mid}" if form == "spm" else f"<P>{pre}<S>{suf}<M>{mid}"
    got = fim.transform(data, *cuts, form)
    assert got.decode() == want
    assert bytes(fim.restore(bytes(got), form)) == data


def test_long_text_crosses_blocks():
    rng = np.random.default_rng(5)
    text = "".join(rng.choice(list("abcé漢 "), 300_000))
    data = text.encode()
    for a, b in ((0, 300_000), (7, 299_999), (65_536, 131_072), (150_000, 150_000)):
        cuts = fim.scan_cuts(np.frombuffer(data, dtype=np.uint8), (a, b))
        for form in ("psm", "spm"):
            got = fim.transform(data, *cuts, form)
            assert len(got) == len(data) + 9
            assert bytes(fim.restore(bytes(got), form)) == data
    assert fim.count_points(np.frombuffer(data, dtype=np.uint8)) == 300_000


def test_query_equals_slicing(spark, make_docs):
    texts = ["", None, "a", "plain words here", "has <M> inside", "<P", "x" * 50_000, "é漢𝄞" * 3_000, "tail <S", "\x00\n\t "]
    rows = [(i, texts[i % len(texts)]) for i in range(400)]
    rows += [(None, "no id"), (7, "another text of a used id"), (7, "another text of a used id")]
    got = sorted(fim_digests(make_docs(rows, n="clash", form="clash", output="clash")).collect(), key=str)

    def sha(x):
        return hashlib.sha256(x.encode()).hexdigest()

    want = []
    for doc_id, text in rows:
        n, form, a, b, out = by_slicing(doc_id, text)
        want.append((doc_id, n, form, a, b, sha(out), sha(text or "")))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_empty_table(spark, make_docs):
    assert fim_digests(make_docs([(1, "a")]).limit(0)).count() == 0
