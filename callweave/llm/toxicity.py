"""Toxicity from a weighted finite-state pattern grammar over clauses.

A clause is read as symbols: insult, threat, target, negation, report, quote, other.  Three
sequential transducers rewrite the symbols: ``negation`` (an insult or threat inside the scope
of a negation), ``reported`` (inside reported or quoted speech) and ``targeted`` (next to the
person addressed).  They are composed into one machine, which gives every matched clause a
weight per outcome; documents add up the clauses' weights, outcome by outcome, and a logistic layer turns
the sums into a probability.  An insult counts through the outcome its clause gives it: bare, aimed at
someone, negated and reported ones are features of their own, and a bare one decides nothing
unless the labels say that it does.

Insult stems come from a small seed list and from labels: prefixes and words whose document
frequency is far higher in toxic documents of a bounded sample (``PER_CLASS`` documents of each
label outside the held-out fold).  Stems only select the clauses to be read, so scoring
is one automaton pass over each whole text plus the grammar on matched clauses.

Defined results: null and empty texts have no clause and get the score of a text without one;
no labelled rows leave the seed list and fixed weights; repeated rows get equal scores; extra
columns are kept; an empty table stays empty.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.llm.common import labelled_sample
from callweave.llm.quality_crf import logistic

PER_CLASS = 4000
MIN_DOCS = 5
MIN_LOG_ODDS = 3.5
MAX_STEMS = 2000
PREFIXES = (4, 5, 6, 7, 8)
TOXIC_FROM = 0.5

# fixed values: seed words of the lexical transducer
INSULTS = ("idiot", "moron", "stupid", "loser", "scum", "worthless", "pathetic", "disgusting", "trash", "clown",
           "imbecile", "dumbass", "dummkopf", "vollidiot", "abschaum", "imbécile", "crétin", "connard", "estúpido",
           "imbécil", "inútil")
THREATS = ("kill", "murder", "strangle", "umbringen", "töten", "vernichten", "tuer", "détruire", "matar", "asesinar")
TARGETS = ("you", "your", "yours", "yourself", "he", "she", "they", "him", "her", "them", "du", "dich", "dir", "ihr",
           "euch", "sie", "tu", "toi", "vous", "ton", "votre", "tú", "ti", "usted", "ustedes", "vosotros")
NEGATIONS = ("not", "never", "no", "isn't", "aren't", "don't", "nicht", "kein", "keine", "nie", "pas", "jamais",
             "aucun", "nunca", "jamás", "tampoco")
REPORTS = ("said", "says", "called", "claimed", "wrote", "quoted", "sagte", "behauptete", "schrieb", "dit",
           "déclaré", "écrit", "dijo", "afirmó", "escribió")
QUOTES = "\"“”«»„"

_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[" + QUOTES + "]")
_CLAUSE_END = re.compile(r"[.!?;\n]")
_IN_WORD = re.compile(r"[^\W\d_]")


# --- transducers --------------------------------------------------------------------------------
@dataclass
class Transducer:
    """Deterministic sequential transducer: (state, symbol) -> (state, symbol out, weight).

    A symbol without an arc is passed on unchanged, weight 0, in the state ``idle[state]``."""

    arcs: dict[tuple[int, str], tuple[int, str, float]]
    idle: dict[int, int] = field(default_factory=dict)

    def step(self, state: int, symbol: str) -> tuple[int, str, float]:
        hit = self.arcs.get((state, symbol))
        return hit if hit else (self.idle.get(state, state), symbol, 0.0)


def compose(first: Transducer, second: Transducer, alphabet: str) -> Transducer:
    """The machine that feeds the output of ``first`` to ``second``; weights add up."""
    number = {(0, 0): 0}
    todo, arcs = [(0, 0)], {}
    while todo:
        pair = todo.pop()
        for symbol in alphabet:
            a, middle, w = first.step(pair[0], symbol)
            b, out, v = second.step(pair[1], middle)
            if (a, b) not in number:
                number[a, b] = len(number)
                todo.append((a, b))
            arcs[number[pair], symbol] = (number[a, b], out, w + v)
    return Transducer(arcs)


def scope(opens: str, changes: dict[str, tuple[str, float]], length: int | None) -> Transducer:
    """After ``opens``, rewrite symbols for ``length`` further symbols (None: to the clause's end)."""
    span = length or 1
    arcs = {(s, opens): (span, opens, 0.0) for s in range(span + 1)}
    for s in range(1, span + 1):
        for a, (b, w) in changes.items():
            arcs[s, a] = (s - 1 if length else s, b, w)
    return Transducer(arcs, {s: s - 1 for s in range(1, span + 1)} if length else {})


ALPHABET = "ITYNRQO"
#: outcomes: plain insult and threat, their negated (n), reported (r) and targeted (J, K) forms
OUTCOMES = "ITJKnr"


def grammar() -> Transducer:
    negation = scope("N", {"I": ("n", -1.0), "T": ("n", -1.0)}, 3)
    told = {"I": ("r", -0.5), "T": ("r", -0.5)}
    report = scope("R", told, None)
    quoted = Transducer({(0, "Q"): (1, "Q", 0.0), (1, "Q"): (0, "Q", 0.0),
                         **{(1, a): (1, b, w) for a, (b, w) in told.items()}})
    target = scope("Y", {"I": ("J", 0.5), "T": ("K", 1.0)}, 4)
    machine = negation
    for part in (report, quoted, target):
        machine = compose(machine, part, ALPHABET)
    return machine


# --- lexicon and scoring --------------------------------------------------------------------------
@dataclass
class ToxicModel:
    stems: dict[str, float]  # "word$" whole word, "stem" prefix
    layer: np.ndarray

    def reader(self) -> "ClauseReader":
        return ClauseReader(self)


class ClauseReader:
    """Finds the clauses that hold a stem and runs the grammar over them."""

    def __init__(self, model: ToxicModel):
        import ahocorasick
        self.layer, self.machine = model.layer, grammar()
        self.whole = {s[:-1]: w for s, w in model.stems.items() if s.endswith("$")}
        self.prefix = {s: w for s, w in model.stems.items() if not s.endswith("$")}
        self.sizes = sorted({len(s) for s in self.prefix})
        self.find = ahocorasick.Automaton()
        for s in {*self.whole, *self.prefix, *THREATS}:
            self.find.add_word(s, len(s))
        self.find.make_automaton()
        self.fixed = {**{w: "Y" for w in TARGETS}, **{w: "N" for w in NEGATIONS}, **{w: "R" for w in REPORTS},
                      **{w: "T" for w in THREATS}, **{q: "Q" for q in QUOTES}}

    def symbol(self, word: str) -> tuple[str, float]:
        w = self.whole.get(word)
        if w is not None:
            return "I", w
        for n in self.sizes:
            if n <= len(word) and (w := self.prefix.get(word[:n])) is not None:
                return "I", w
        return self.fixed.get(word, "O"), 1.0

    def clauses(self, text: str) -> Iterator[str]:
        """Clauses of a lower-cased text that hold a stem at a word's start."""
        done, free = -1, 0
        for end, n in self.find.iter(text):
            start = end - n + 1
            if start < done or (start and _IN_WORD.match(text[start - 1])):
                continue
            stop = _CLAUSE_END.search(text, end)
            done = stop.end() if stop else len(text)
            # what lies before the clause read last is never looked at again
            begin = max(text.rfind(c, free, start) for c in ".!?;\n") + 1
            yield text[max(begin, free):done]
            free = done

    def features(self, text: str | None) -> list[float]:
        total = dict.fromkeys(OUTCOMES, 0.0)
        if text:
            for clause in self.clauses(text.lower()):
                state = 0
                for word in _WORD.findall(clause):
                    symbol, strength = self.symbol(word)
                    state, out, weight = self.machine.step(state, symbol)
                    if out in total:
                        total[out] += strength * math.exp(weight)
        return [1.0, *(f(total[o]) for o in OUTCOMES for f in ((lambda x: min(x, 1.0)), math.log1p))]

    def score(self, text: str | None) -> float:
        return 1 / (1 + math.exp(-float(np.dot(self.layer, self.features(text)))))


#: layer before any label is seen, two numbers per outcome (present, how much): an insult or a threat that is
#: aimed at someone decides, an insult by itself does not, negated and reported ones add little
DEFAULT_LAYER = np.array([-3.0, 0.8, 0.4, 1.0, 0.6, 3.0, 1.0, 4.0, 1.0, 0.1, 0.1, 0.2, 0.2])


def choose_stems(counts: dict[str, tuple[int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Stems far more frequent in toxic documents, the longest of equal reach, the shortest of nested ones."""
    good = {}
    for s, (a, b) in counts.items():
        odds = math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1))
        if a >= MIN_DOCS and odds >= MIN_LOG_ODDS:
            good[s] = (a, odds)
    longer: dict[str, int] = {}
    for s, (a, _) in good.items():
        body = s.rstrip("$")
        for n in range(min(PREFIXES), len(body) + (s[-1] == "$")):
            longer[body[:n]] = max(longer.get(body[:n], 0), a)
    kept: dict[str, float] = {}
    for s in sorted(good, key=lambda s: (len(s), s)):
        a, odds = good[s]
        if not s.endswith("$") and longer.get(s, 0) >= a:
            continue
        body = s.rstrip("$")
        if any(body[:n] in kept for n in range(min(PREFIXES), len(body) + 1)):
            continue
        kept[s] = odds
    best = sorted(kept, key=lambda s: (-good[s][0], s))[:MAX_STEMS]
    return {s: min(1.0, kept[s] / 6) for s in best}


def _stem_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for text, label in zip(batch.column("text"), batch.column("label")):
            words = set(re.findall(r"[^\W\d_]+", (text.as_py() or "").lower()))
            stems = {w[:n] for w in words for n in PREFIXES if len(w) >= n}
            stems.update(w + "$" for w in words if len(w) >= 3)
            found[label.as_py()].update(stems)
        names = list({*found[0], *found[1]})
        yield pa.RecordBatch.from_arrays([
            pa.array(names, pa.string()), pa.array([found[1][s] for s in names], pa.int64()),
            pa.array([found[0][s] for s in names], pa.int64())], names=["stem", "toxic", "clean"])


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> ToxicModel:
    seeds = {w + "$": 1.0 for w in INSULTS}
    sample, sizes = labelled_sample(docs, labels, "toxic", per_class)
    sample = sample.select(F.col("text").cast("string").alias("text"), "label")
    drawn = {c: min(per_class, sizes.get(c, 0)) for c in (0, 1)}
    if not drawn[1] or not drawn[0]:
        return ToxicModel(seeds, DEFAULT_LAYER)
    counts = sample.mapInArrow(_stem_counts, "stem string, toxic long, clean long") \
        .groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")) \
        .filter((F.col("toxic") >= MIN_DOCS) & (F.col("toxic") * drawn[0] > F.col("clean") * drawn[1] * 5)).collect()
    stems = seeds | choose_stems({r["stem"]: (r["toxic"], r["clean"]) for r in counts}, drawn[1], drawn[0])
    model = ToxicModel(stems, DEFAULT_LAYER)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches):
        reader = shared.value.reader()
        for b in batches:
            x = [reader.features(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("label"), pa.array(x, pa.list_(pa.float64()))], names=["label", "x"])

    found = sorted(tuple(r) for r in sample.mapInArrow(rows, "label int, x array<double>").collect())
    label = np.array([r[0] for r in found], dtype=np.float64)
    if len(set(label)) < 2:
        return model
    weight = np.where(label == 1, sizes[1] / max(1, (label == 1).sum()), sizes[0] / max(1, (label == 0).sum()))
    layer = logistic(np.array([r[1] for r in found]), label, weight)
    return ToxicModel(stems, layer)


def score_toxicity(docs: DataFrame, model: ToxicModel, name: str = "toxic_score") -> DataFrame:
    """``docs`` with the probability of label 1 in column ``name`` (which replaces one of that name)."""
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != name])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        reader = shared.value.reader()
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                got = [reader.score(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(got, pa.float64())],
                                                 names=[*part.schema.names, name])

    return kept.mapInArrow(score, T.StructType([*kept.schema.fields, T.StructField(name, T.DoubleType())]))
