"""Personal data with offset-preserving deobfuscation.

Base identifiers are found on the text itself.  The method adds identifiers that only appear
after normalisation: a chain of transducers rewrites the text while every output character
remembers the source range it came from: homoglyphs and invisible characters, spelled digits,
then at/dot disguises.  The same four detectors run on the rewritten text, and a span that
touches a rewritten place and no base span is mapped back to source characters.

Scanning is linear: a character run is entered once (possessive quantifiers, or expansion from
an anchor character), so a text of one very long run costs no more than any other.

Spans count code points, the end is exclusive.  Defined results: null and empty texts have no
span; repeated rows give repeated results; extra columns are ignored; an empty table stays empty.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.llm.bytewords import WordHasher, alnum_words, text_chunks
from callweave.llm.common import read_columns

KINDS = ("email", "ip", "card", "phone")
SCHEMA = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
          "n_added long")

# --- base detectors -------------------------------------------------------------------------------
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]++")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free = 0
    at = text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at)
        if m:
            begin = at
            while begin > free and text[begin - 1] in _LOCAL_CHARS:
                begin -= 1
            if begin < at:
                yield begin, m.end()
                free = m.end()
        at = text.find("@", max(at + 1, free))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        body = m[0].rstrip(" ().-")  # the last character is a digit
        if len(body) >= 4 or (len(body) == 3 and body[1:].isdigit()):
            n = sum(c.isdigit() for c in body)
            # + digit, one or more characters of the class, digit
            if len(body) >= 4 and 9 <= n <= 15:
                yield m.start(), m.start() + len(body)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the base identifiers, by start and kind."""
    out: list[tuple[int, int, int]] = []
    digits = _HAS_DIGIT.search(text) is not None
    if "@" in text:
        out += [(a, 0, b) for a, b in _emails(text)]
    if digits:
        if "." in text:
            out += [(a, 1, b) for a, b in _ips(text)]
        out += [(a, 2, b) for a, b in _cards(text)]
        if "+" in text:
            out += [(a, 3, b) for a, b in _phones(text)]
    return sorted(out)


_HAS_DIGIT = re.compile("[0-9]")

# --- deobfuscation --------------------------------------------------------------------------------
# fixed values: Cyrillic and Greek letters that look like a Latin letter, and its replacement
_LOOKALIKES = dict(zip(
    "аеіјорсухԁһѕԛԝВАЕІЈКМНОРСТУХЅ" "αοεινρτυκΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
    "aeijopcyxdhsqwBAEIJKMHOPCTYXS" "aoeivptukABEZHIKMNOPTYX"))
_INVISIBLE = ("\N{ZERO WIDTH SPACE}\N{ZERO WIDTH NON-JOINER}\N{ZERO WIDTH JOINER}"
              "\N{WORD JOINER}\N{ZERO WIDTH NO-BREAK SPACE}\N{SOFT HYPHEN}")
_DASHES = ("\N{HYPHEN}\N{NON-BREAKING HYPHEN}\N{FIGURE DASH}"
           "\N{EN DASH}\N{EM DASH}\N{MINUS SIGN}")
#: full-width forms, full stops, no-break and thin spaces, enclosed, raised and lowered digits,
#: Arabic-Indic digits, mathematical letters and digits
_ODD = re.compile("[" + "".join(_LOOKALIKES) + _INVISIBLE + _DASHES
                  + "\uff01-\uff5e\uff61\u3002\u2024\u00a0\u2007\u2009\u202f\u2460-\u249b"
                  + "\xb2\xb3\xb9\u2070-\u2089\u0660-\u0669\u06f0-\u06f9\U0001d400-\U0001d7ff]")
# fixed values: digits as words
_SPELLED = {w: str(i) for words in (
    ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine"),
    ("null", "eins", "zwei", "drei", "vier", "fünf", "sechs", "sieben", "acht", "neun"),
    ("zéro", "un", "deux", "trois", "quatre", "cinq", "six", "sept", "huit", "neuf"),
    ("cero", "uno", "dos", "tres", "cuatro", "cinco", "seis", "siete", "ocho", "nueve"))
    for i, w in enumerate(words)} | {"oh": "0"}
_DIGIT_WORD = "(?:" + "|".join(sorted(_SPELLED, key=len, reverse=True)) + ")"
#: a digit word with the digits, signs and digit words behind it; rewritten where these are
#: three or more, or where a written digit stands before it
_RUN = re.compile(rf"(?<!\w){_DIGIT_WORD}(?!\w)(?:[ ,.-]{{1,2}}(?:{_DIGIT_WORD}|[0-9]+|plus|dot|point|punkt|punto)(?!\w))*",
                  re.IGNORECASE)
_AFTER_DIGIT = re.compile(r"[0-9](?:[ .-]| (?:dot|point|punkt|punto) )$", re.IGNORECASE)
_RUN_PART = re.compile(rf"{_DIGIT_WORD}|[0-9]+|plus|dot|point|punkt|punto|[ ,.-]+", re.IGNORECASE)
_PLUS = re.compile(r"(?<!\w)plus[ -]$", re.IGNORECASE)
# fixed values: disguised signs
_AT = "at|arroba|arobase|chez|ät"
_DOT = "dot|punto|point|punkt"
_BRACKETED = re.compile(rf"(?<!\s)\s*[\[({{<]\s*(?:({_AT}|@)|({_DOT}|\.))\s*[\])}}>]\s*", re.IGNORECASE)
#: bare words only as a whole address: local at domain dot domain
_BARE = re.compile(rf"(?<![\w.%+-])[a-z0-9._%+-]{{1,64}}(\s+(?:{_AT})\s+)[a-z0-9-]{{1,63}}"
                   rf"(?:(?:\s+(?:{_DOT})\s+|\.)[a-z0-9-]{{2,63}}){{1,5}}(?![\w-])", re.IGNORECASE)
_BARE_DOT = re.compile(rf"\s+(?:{_DOT})\s+", re.IGNORECASE)
#: with a written dot in the domain, a bare "at" counts only behind words joined by . _ or +
_PLAIN = re.compile(r"[a-z][a-z0-9]*(?:[._+][a-z][a-z0-9]*)+\s+\w+\s+[a-z0-9.-]*\.[a-z]{2,}", re.IGNORECASE)
#: four numbers with written or spelled dots
_BARE_IP = re.compile(rf"(?<![0-9])[0-9]++(?:(?:\s+(?:{_DOT})\s+|\.)[0-9]++){{3}}", re.IGNORECASE)
_TRIGGERS = ("dot", "punto", "point", "punkt")
_AT_WORDS = ("at", "arroba", "arobase", "chez", "ät")


class Traced:
    """A text whose characters know the source range they stand for."""

    def __init__(self, text: str):
        self.text = text
        self.start = np.arange(len(text), dtype=np.int64)
        self.end = self.start + 1
        self.changed: list[tuple[int, int]] = []  # source ranges that were rewritten

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace the ranges (first, end, new text), given in order without overlap."""
        if not edits:
            return
        parts, start, end, at = [], [], [], 0
        for a, b, new in edits:
            parts += [self.text[at:a], new]
            start += [self.start[at:a], np.repeat(self.start[a:a + 1], len(new))]
            end += [self.end[at:a], np.repeat(self.end[b - 1:b], len(new))]
            self.changed.append((int(self.start[a]), int(self.end[b - 1])))
            at = b
        parts.append(self.text[at:])
        self.text = "".join(parts)
        self.start, self.end = np.concatenate([*start, self.start[at:]]), np.concatenate([*end, self.end[at:]])


def _homoglyphs(t: Traced) -> None:
    edits = []
    for m in _ODD.finditer(t.text):
        c = m[0]
        new = _LOOKALIKES.get(c)
        if new is None:
            new = "" if c in _INVISIBLE else "-" if c in _DASHES else "." if c in "\u3002\uff61" \
                else unicodedata.normalize("NFKC", c)
            if c.isdigit() and not new.isascii():
                new = str(unicodedata.digit(c))
        if new != c:
            edits.append((m.start(), m.end(), new))
    t.rewrite(edits)


def _spelled(t: Traced, breaks: bool) -> bool:
    """Rewrites runs of spelled digits, word by word, so that a span ends with its last word.

    The signs between the words go.  With ``breaks`` those stay that may end a number (a comma, a full stop
    before a space).  Says whether there were such breaks."""
    edits, found = [], False
    for m in _RUN.finditer(t.text):
        begin = m.start()
        parts = [(p[0].lower(), p.start(), p.end()) for p in _RUN_PART.finditer(t.text, m.start(), m.end())]
        if sum(w[0] not in " ,.-" for w, _, _ in parts) < 4 and not _AFTER_DIGIT.search(t.text, max(0, begin - 8), begin):
            continue
        lead = _PLUS.search(t.text, max(0, begin - 6), begin)
        if lead:
            edits.append((lead.start(), begin, "+"))
        for w, a, b in parts:
            ends = "," in w or w == ". "
            found |= ends
            if w.isdigit() or (ends and breaks):
                continue
            edits.append((a, b, _SPELLED.get(w) or ("+" if w == "plus" else "." if w in _TRIGGERS else "")))
    t.rewrite(edits)
    return found


def _bracketed(t: Traced) -> None:
    t.rewrite([(m.start(), m.end(), "@" if m[1] else ".") for m in _BRACKETED.finditer(t.text)
               if m.start() and m.end() < len(t.text)])


def _bare(t: Traced) -> None:
    edits = []
    for m in _BARE.finditer(t.text):
        if not _BARE_DOT.search(m[0]) and not _PLAIN.fullmatch(m[0]):
            continue  # "meet at example.com" is prose; a spelled dot or "jane.doe at" is not
        edits.append((m.start(1), m.end(1), "@"))
        edits += [(d.start(), d.end(), ".") for d in _BARE_DOT.finditer(t.text, m.end(1), m.end())]
    t.rewrite(edits)


def _bare_ips(t: Traced) -> None:
    t.rewrite([(d.start(), d.end(), ".") for m in _BARE_IP.finditer(t.text)
               for d in _BARE_DOT.finditer(t.text, m.start(), m.end())])


_HAS_BRACKET = re.compile(rf"[\[({{<]\s*(?:{_AT}|@|{_DOT}|\.)\s*[\])}}>]", re.IGNORECASE)


def added_spans(text: str, base: list[tuple[int, int, int]], spelled: bool = True,
                dotted: bool = True) -> list[tuple[int, int, int]]:
    """Spans that only the rewritten text shows and that touch no base span.

    ``spelled`` and ``dotted``: whether the text can hold spelled digits, or a bare at or spelled dot.
    Where a run of spelled digits holds signs that may end a number, the run is read up to them first, and then
    as a whole; of two readings that overlap the first counts."""
    taken = _merged([(a, b) for a, _, b in base])
    out, more = _reading(text, taken, spelled, dotted, True)
    if more:
        taken = _merged([*zip(*taken), *((a, b) for a, _, b in out)])
        out = sorted(out + _reading(text, taken, spelled, dotted, False)[0])
    return out


def _reading(text: str, taken: tuple[list[int], list[int]], spelled: bool, dotted: bool,
             breaks: bool) -> tuple[list[tuple[int, int, int]], bool]:
    """(spans of the rewritten text that touch a rewritten place and none of ``taken``, whether breaks were met)."""
    t, more = Traced(text), False
    if not text.isascii():
        _homoglyphs(t)
    if spelled:
        more = _spelled(t, breaks)
    if _HAS_BRACKET.search(t.text):
        _bracketed(t)
    if dotted:
        _bare(t)
        _bare_ips(t)
    if not t.changed:
        return [], False
    changed = _merged(t.changed)
    out = []
    for a, kind, b in base_spans(t.text):
        lo, hi = int(t.start[a]), int(t.end[b - 1])
        if _touches(changed, lo, hi) and not _touches(taken, lo, hi):
            out.append((lo, kind, hi))
    return out, more


def _merged(ranges: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """(starts, ends) of the union of ``ranges``, ascending and apart."""
    starts, ends = [], []
    for a, b in sorted(ranges):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def _touches(ranges: tuple[list[int], list[int]], lo: int, hi: int) -> bool:
    starts, ends = ranges
    i = bisect_left(starts, hi)
    return i > 0 and ends[i - 1] > lo


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


#: a character that the gate's words don't treat as the patterns above do: not ASCII, a Latin
#: letter, a sign of Latin-1, punctuation or a symbol (and those whose other case is ASCII)
_UNGATED = re.compile("[^\x00-\xd6\xd8-\xf6\xf8-\u012f\u0132-\u017e\u0180-\u024f\u2000-\u2129\u212b-\u2bff\u3000-\u303f]")


class Gate:
    """Which texts of a chunk can hold spelled digits, or a bare at or spelled dot, from word hashes.

    It lets every text through that the patterns can rewrite.  A homoglyph inside a word hides
    it here, so texts with ``_ODD`` or ``_UNGATED`` characters are searched as well."""

    def __init__(self):
        self.hasher = WordHasher(alnum_words(), lower=True)
        self.digits, self.dots = self._table(_SPELLED), self._table(_TRIGGERS)
        self.ats, self.plus = self._table(_AT_WORDS), self._table(["plus"])

    def _table(self, words: Iterable[str]) -> np.ndarray:
        data = np.frombuffer(" ".join(v for w in words for v in (w, w.upper())).encode(), dtype=np.uint8)
        starts, ends, _ = self.hasher.bounds(data, np.array([0, len(data)]))
        return np.unique(self.hasher.hashes(data, starts, ends))

    def flags(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        data = _signs_blank(data)
        starts, ends, first = self.hasher.bounds(data, offs)
        h = self.hasher.hashes(data, starts, ends)
        spelled, dotted = np.zeros(len(offs) - 1, dtype=bool), np.zeros(len(offs) - 1, dtype=bool)
        if not len(h):
            return spelled, dotted
        word, dot = _among(h, self.digits), _among(h, self.dots)
        digit = lambda b: (b >= 0x30) & (b <= 0x39)
        run = word | dot | _among(h, self.plus) | digit(data[starts]) | digit(data[ends - 1])
        doc = lambda i: np.searchsorted(first, i, side="right") - 1
        at = np.flatnonzero(word)
        for step in (-1, 1):  # a digit word beside another word of a run
            near = np.clip(at + step, 0, len(h) - 1)
            d = doc(at)
            spelled[d[run[near] & (near != at) & (doc(near) == d)]] = True
        dotted[doc(np.flatnonzero(dot))] = True
        at = np.flatnonzero(_among(h, self.ats))
        at = at[(at > 0) & (at < len(h) - 1)]
        before, after = data[np.maximum(starts[at - 1] - 1, 0)], data[np.minimum(ends[at + 1], len(data) - 1)]
        dotted[doc(at[np.isin(before, _JOINS) & np.isin(after, _JOINS)])] = True
        return spelled, dotted


_JOINS = np.frombuffer(b"._+-", dtype=np.uint8)


def _signs_blank(data: np.ndarray) -> np.ndarray:
    """``data`` (UTF-8) with blanks for U+0080-BF, U+2000-2BFF and U+3000-303F: no word has them."""
    if not (data >= 0x80).any():
        return data
    data, nxt = data.copy(), np.append(data[1:], 0)
    two = np.flatnonzero(data == 0xC2)
    three = np.flatnonzero(((data == 0xE2) & (nxt < 0xB0)) | ((data == 0xE3) & (nxt == 0x80)))
    for at, n in ((two, 2), (three, 3)):
        for k in range(n):
            data[at[at + k < len(data)] + k] = 0x20
    return data


def _among(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    gate = Gate()
    for batch in batches:
        for lo, hi, data, offs in text_chunks(batch.column("text")):
            spelled, dotted = gate.flags(data, offs)
            part = batch.slice(lo, hi - lo)
            rows = []
            for i, text in enumerate(part.column("text").to_pylist()):
                base = base_spans(text) if text else []
                odd = bool(text) and not text.isascii() and bool(_ODD.search(text) or _UNGATED.search(text))
                more = added_spans(text, base, spelled[i] or odd, dotted[i] or odd) if text else []
                n = [0, 0, 0, 0]
                for _, k, _ in base:
                    n[k] += 1
                rows.append((*n, hashlib.sha256(written(base).encode()).hexdigest(), written(base + more), len(more)))
            cols = list(zip(*rows))
            types = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *[pa.array(c, t) for c, t in zip(cols, types)]],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, base counts by kind, digest of the base spans, all spans, number of added spans."""
    return read_columns(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(_scan, SCHEMA)
