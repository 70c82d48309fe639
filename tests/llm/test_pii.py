import hashlib
import random
import re

import pytest

from callweave.llm import pii as P

PLAIN = [re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")]


def brute(text):
    out = []
    for kind, pattern in enumerate(PLAIN):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == 0 or kind == 1 and all(int(p) <= 255 for p in m[0].split(".")) \
                    or kind == 2 and 12 <= len(digits) <= 19 and P.luhn(digits) or kind == 3 and 9 <= len(digits) <= 15:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(1)
    for _ in range(40000):
        alphabet = rng.choice(["a.@-1 ", "+12 ().-3", "0123.5 ", "4111 -", "a@b.c1+ (%"])
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30)))
        assert P.base_spans(text) == brute(text), text
    assert P.luhn("4111111111111111") and not P.luhn("4111111111111112")


@pytest.mark.parametrize("text,kind,source", [
    ("mail john.doe [at] example [dot] com now", "email", "john.doe [at] example [dot] com"),
    ("write jane at example dot org please", "email", "jane at example dot org"),
    ("see jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
    ("jo​hn@exam­ple.com", "email", "jo​hn@exam­ple.com"),
    ("call plus one three one nine five five five four one two three today", "phone", "plus one three one nine five five five four one two three"),
    ("＋１ (３１９) ５５５-５１３２", "phone", None),
    ("karte vier " + "eins " * 15 + "ok", "card", "vier " + ("eins " * 15).strip()),
    ("one nine two dot one six eight dot one dot one", "ip", "one nine two dot one six eight dot one dot one"),
])
def test_disguised_identifiers_map_back_to_the_source(text, kind, source):
    got = P.added_spans(text, P.base_spans(text))
    assert [(P.KINDS[k], text[a:b]) for a, k, b in got] == [(kind, source or text)]


@pytest.mark.parametrize("text", ["meet at example.com", "x at y dot z", "five five five", "un un un un un", "", "a (at) b",
                                  "plain a@b.co and 10.0.0.1"])
def test_prose_and_base_identifiers_add_nothing(text):
    assert P.added_spans(text, P.base_spans(text)) == []


def test_documents(make_docs):
    rows = [(1, "a@b.co, 10.0.0.1 jane at example dot org"), (2, None), (3, ""), (1, "a@b.co, 10.0.0.1 jane at example dot org"),
            (None, "+1 (319) 555-5132 \U0001f600 x@y.zz"), (4, "1" * 100000 + "+1" * 5000 + "a@" * 5000), (5, "one " * 20000)]
    got = P.find_personal_data(make_docs(rows, spans="x", n_email=9)).collect()
    assert len(got) == len(rows)
    for r in got:
        text = next(t for i, t in rows if i == r.doc_id) or ""
        spans = brute(text)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for _, k, _ in spans) for x in range(4)]
        joined = ",".join(f"{P.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))
    assert next(r for r in got if r.doc_id == 1).spans == "email:0:6,ip:8:16,email:17:40"
    assert P.find_personal_data(make_docs([])).count() == 0


DISGUISED = [
    ("pay with four 111 1111 1111 1111 now", "card", "four 111 1111 1111 1111"),
    ("pay with 4111 1111 1111 111 one", "card", "4111 1111 1111 111 one"),
    ("pay with 4111-1111-one 111-1111 now", "card", "4111-1111-one 111-1111"),
    ("\u201cfour 111 1111 1111 1111\u201d", "card", "four 111 1111 1111 1111"),
    ("call +1 five 55 01 23 44 today", "phone", "+1 five 55 01 23 44"),
    ("host 192 dot 168 dot 1 dot 10 is up", "ip", "192 dot 168 dot 1 dot 10"),
    ("host 192 dot 168 dot one dot 10 is up", "ip", "192 dot 168 dot one dot 10"),
    ("host 10.20 punto 30.one is up", "ip", "10.20 punto 30.one"),
    ("write to jane.doe at example.com today", "email", "jane.doe at example.com"),
    ("write to jane_doe\u2003at\u2003my-mail.example.com.", "email", "jane_doe\u2003at\u2003my-mail.example.com"),
    ("write jane at example dot org", "email", "jane at example dot org"),
    ("karte F\u00dcNF " + "eins " * 15 + "ok", None, None),
]
PROSE = ["meet at example.com", "see section 3. One of 12 dot points", "e.g. at example.com", "jane.doe at 10.30", "version 3 point 5",
         "room 12 one at home.Then", "four 111 1111 1111 1112", "un un 3 un"]


def test_disguises_are_found_in_documents_whatever_else_the_text_holds(make_docs):
    texts = [t for t, _, _ in DISGUISED] + PROSE
    # an odd character elsewhere opens the search of the whole text
    got = {r.doc_id: r.spans for r in P.find_personal_data(make_docs(
        [(i, t) for i, t in enumerate(texts)] + [(100 + i, t + " \uff21") for i, t in enumerate(texts)])).collect()}
    for i, text in enumerate(texts):
        assert got[i] == got[100 + i], text
    for i, (text, kind, source) in enumerate(DISGUISED):
        if kind:
            at = text.index(source)
            assert got[i] == f"{kind}:{at}:{at + len(source)}", text
    assert all(not got[len(DISGUISED) + i] for i in range(len(PROSE)))


def test_gate_lets_through_what_the_patterns_rewrite():
    rng, gate = random.Random(2), P.Gate()
    parts = ["four", "FIVE", "zéro", "fünf", "FÜNF", "un", "12", "7", "plus", "dot", "punkt", "at", "jane.doe", "a_b", "x", "example.com",
             "my-host.org", "été", "“", "”", "…", "3rd"]
    texts = [rng.choice(["", " "]) + "".join(rng.choice(parts) + rng.choice([" ", " ", "-", ".", ", ", "\u2009", "\u2003", "\n", ""])
                                            for _ in range(rng.randint(1, 8))) for _ in range(4000)]
    raw = [t.encode() for t in texts]
    offs = P.np.concatenate(([0], P.np.cumsum([len(r) for r in raw])))
    spelled, dotted = gate.flags(P.np.frombuffer(b"".join(raw), dtype=P.np.uint8), offs)
    for text, a, b in zip(texts, spelled, dotted):
        if P._ODD.search(text) or P._UNGATED.search(text):
            continue
        one, two = P.Traced(text), P.Traced(text)
        P._spelled(one, True)
        P._bare(two)
        P._bare_ips(two)
        assert (a or not one.changed) and (b or not two.changed), text
    assert 0 < spelled.sum() < len(texts) and 0 < dotted.sum() < len(texts)


CARD = "four" + " one" * 15


@pytest.mark.parametrize("text,source", [
    (f"card {CARD}, two apples", CARD),
    (f"card {CARD}. Two apples", CARD),
    (f"{CARD} and more", CARD),
    ("pay four, " + ", ".join(["one"] * 15) + " now", "four, " + ", ".join(["one"] * 15)),
    ("four one one one. " * 1 + "one " * 11 + "one end", "four one one one. " + "one " * 11 + "one"),
])
def test_runs_are_read_up_to_their_breaks_and_as_a_whole(text, source):
    got = P.added_spans(text, P.base_spans(text))
    assert [(P.KINDS[k], text[a:b]) for a, k, b in got] == [("card", source)]


def test_a_phone_ends_with_its_last_word():
    text = "call plus four nine one two three four five six seven, two of us"
    (a, k, b), = P.added_spans(text, P.base_spans(text))
    assert (P.KINDS[k], text[a:b]) == ("phone", "plus four nine one two three four five six seven")


def test_time_follows_the_length():
    import time
    part = "plain.user@example.com and jane.doe at example dot org, ip 10.0.0.1; " + CARD + ", two. "
    took = {}
    for n in (1 << 20, 10 << 20):
        text = part * (n // len(part))
        t = time.process_time()
        found = P.added_spans(text, P.base_spans(text))
        took[n] = time.process_time() - t
        assert len(found) == 2 * (n // len(part))
    assert took[10 << 20] < 25 * took[1 << 20] + 1
    spaces = "a" + " " * 300_000 + "[at] b [dot] org"
    t = time.process_time()
    P.added_spans(spaces, [])
    assert time.process_time() - t < 5
