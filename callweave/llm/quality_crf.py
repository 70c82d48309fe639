"""Document quality from a linear-chain conditional random field over lines.

Every line with a word is labelled good or bad.  Its features are shares of character classes,
word repetition and shape, and the same values of the lines before and after it.  Transition
weights couple neighbouring labels; forward-backward gives each line's marginal, and the mean
marginal weighted by line length is the document's quality, calibrated to a probability.

Training takes a bounded sample (``PER_CLASS`` documents of each label outside the held-out
fold, of at most ``MAX_LINES`` lines each).  Lines of good documents are good; lines of bad
documents start as bad and are relabelled by the model (hard EM).  Scoring covers every line of
every document and shuffles nothing.

Defined results: a null or empty text, or one without words, is one empty line and gets a score
from its features; no labelled rows give 0.5 everywhere and one label alone its own value;
repeated rows get equal scores; extra columns are kept as they are; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.llm.bytewords import WordHasher, mix64, space_words, text_chunks
from callweave.llm.common import free_name, labelled_sample

PER_CLASS = 1500
MAX_LINES = 2000
#: lines of all sampled documents together (their features reach the driver: 112 bytes a line, then 224)
SAMPLE_LINES = 1_000_000
EM_ROUNDS = 2
REJECT_BELOW = 0.3
_BASE = ["bias", "log_words", "upper", "digit", "symbol", "bang", "punct", "wide", "distinct", "adjacent",
         "word_length", "repeated_line", "ends_sentence", "short"]
_NEAR = [_BASE.index(x) for x in ("upper", "symbol", "bang", "distinct", "adjacent", "repeated_line")]
N_FEATURES = len(_BASE) + 2 * len(_NEAR) + 2


def _classes() -> np.ndarray:
    """Byte -> 1 upper, 2 lower, 3 digit, 4 symbol, 5 ! or ?, 6 other punctuation, 7 lead byte, 0 rest."""
    c = np.zeros(256, dtype=np.uint8)
    c[0x21:0x7F] = 6
    c[0x41:0x5B], c[0x61:0x7B], c[0x30:0x3A] = 1, 2, 3
    c[[ord(x) for x in "#*$%&|<>"]] = 4
    c[[ord("!"), ord("?")]] = 5
    c[0xC0:] = 7
    return c


_CLASS = _classes()


def line_features(hasher: WordHasher, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, lengths, first): one row per line with a word; ``first`` bounds each text's lines."""
    n_docs = len(offs) - 1
    starts, ends, first_word = hasher.bounds(data, offs)
    h = hasher.hashes(data, starts, ends)
    # all lines: a text starts one, and so does every byte after a line feed inside a text
    lf = np.flatnonzero(data == 0x0A) + 1
    begin = np.unique(np.concatenate([offs[:-1][np.diff(offs) > 0], lf[lf < len(data)]]))
    word_line = np.searchsorted(begin, starts, side="right") - 1
    used, word_line = np.unique(word_line, return_inverse=True)
    lo = begin[used]
    hi = np.append(begin, len(data))[used + 1]
    doc = np.searchsorted(offs, lo, side="right") - 1
    hi = np.minimum(hi, offs[doc + 1])
    n = len(lo)
    words = np.bincount(word_line, minlength=n).astype(np.float64)
    size = (hi - lo).astype(np.float64)
    cls = _CLASS[data]
    share = {}
    for k in range(1, 8):
        c = np.concatenate(([0], np.cumsum(cls == k, dtype=np.int32)))
        share[k] = (c[hi] - c[lo]).astype(np.float64)
    letters = share[1] + share[2] + share[7]
    visible = np.maximum(letters + share[3] + share[4] + share[5] + share[6], 1)
    # distinct words and immediate repetitions of each line
    key = np.sort((word_line.astype(np.uint64) << np.uint64(40)) | (h >> np.uint64(24)))
    fresh = np.ones(len(key), dtype=bool)
    fresh[1:] = key[1:] != key[:-1]
    distinct = np.bincount((key[fresh] >> np.uint64(40)).astype(np.int64), minlength=n)
    again = np.zeros(len(h), dtype=bool)
    again[1:] = (h[1:] == h[:-1]) & (word_line[1:] == word_line[:-1])
    adjacent = np.bincount(word_line, weights=again, minlength=n)
    # a line that equals an earlier one of its text
    first_of_line = np.searchsorted(word_line, np.arange(n))
    place = (np.arange(len(h)) - first_of_line[word_line]).astype(np.uint64) if n else np.zeros(0, dtype=np.uint64)
    mark = np.add.reduceat(mix64(h + place * np.uint64(0x9E3779B97F4A7C15)), first_of_line) if n else np.zeros(0, np.uint64)
    order = np.lexsort((np.arange(n), mark, doc))
    repeated = np.zeros(n)
    same = (mark[order][1:] == mark[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    repeated[order[1:][same]] = 1
    last = data[ends[np.searchsorted(word_line, np.arange(n), side="right") - 1] - 1] if n else np.zeros(0, np.uint8)
    f = np.zeros((n, len(_BASE)))
    f[:, 0] = 1
    f[:, 1] = np.log1p(words) / 5
    f[:, 2] = share[1] / np.maximum(letters, 1)
    for col, k in ((3, 3), (4, 4), (5, 5), (6, 6), (7, 7)):
        f[:, col] = share[k] / visible
    f[:, 8] = distinct / np.maximum(words, 1)
    f[:, 9] = adjacent / np.maximum(words, 1)
    f[:, 10] = visible / np.maximum(words, 1) / 10
    f[:, 11] = repeated
    f[:, 12] = np.isin(last, [ord("."), ord("!"), ord("?")])
    f[:, 13] = words < 4
    # texts without a word are one empty line
    count = np.bincount(doc, minlength=n_docs)
    empty = np.flatnonzero(count == 0)
    if len(empty):
        blank = np.zeros((len(empty), len(_BASE)))
        blank[:, 0] = 1
        where = np.concatenate([doc, empty])
        o = np.argsort(where, kind="stable")
        f, size, doc = np.concatenate([f, blank])[o], np.concatenate([size, np.ones(len(empty))])[o], where[o]
        count = np.bincount(doc, minlength=n_docs)
    first = np.concatenate(([0], np.cumsum(count)))
    before, after = np.zeros((len(f), len(_NEAR) + 1)), np.zeros((len(f), len(_NEAR) + 1))
    joined = doc[1:] == doc[:-1]
    before[:, -1] = 1
    after[:, -1] = 1
    at = np.flatnonzero(joined)
    before[at + 1, :-1], before[at + 1, -1] = f[at][:, _NEAR], 0
    after[at, :-1], after[at, -1] = f[at + 1][:, _NEAR], 0
    return np.hstack([f, before, after]), size, first


# --- the chain ----------------------------------------------------------------------------------
def marginals(score: np.ndarray, first: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """P(good) of every line, expected transition counts (2, 2), and log Z over all chains.

    ``score`` is the log odds of good from the features; ``trans[a, b]`` the weight of label b
    after a.  Chains advance together, longest first, so a step costs the chains still running."""
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    order = order[length[order] > 0]
    run, begin = length[order], first[:-1][order]
    p = np.empty((len(score), 2))
    big = np.maximum(score, 0)
    p[:, 0], p[:, 1] = np.exp(-big), np.exp(score - big)
    m = np.exp(trans - trans.max())
    alpha, scale = np.empty_like(p), np.empty(len(score))
    steps = int(run[0]) if len(run) else 0
    for t in range(steps):
        k = np.searchsorted(-run, -t, side="left")  # chains longer than t
        i = begin[:k] + t
        a = p[i] if t == 0 else (alpha[i - 1] @ m) * p[i]
        scale[i] = a.sum(axis=1)
        alpha[i] = a / scale[i][:, None]
    beta = np.ones_like(p)
    pair = np.zeros((2, 2))
    for t in range(steps - 1, 0, -1):
        k = np.searchsorted(-run, -t, side="left")
        i = begin[:k] + t
        right = p[i] * beta[i] / scale[i][:, None]
        beta[i - 1] = right @ m.T
        pair += (alpha[i - 1].T @ right) * m
    gamma = alpha * beta
    inner = len(score) - len(run)
    log_z = float(np.log(scale).sum() + big.sum() + inner * trans.max())
    return gamma[:, 1] / gamma.sum(axis=1), pair, log_z


@dataclass
class LineModel:
    weights: np.ndarray
    trans: np.ndarray
    calibration: np.ndarray  # probability = sigmoid(c0 + c1 * logit(mean marginal))
    constant: float | None = None

    def line_marginals(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        return marginals(features @ self.weights, first, self.trans)[0]

    def document_scores(self, features: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(first) - 1, self.constant)
        good = self.line_marginals(features, first)
        mean = np.add.reduceat(good * size, first[:-1]) / np.add.reduceat(size, first[:-1]) if len(first) > 1 else good
        return _sigmoid(self.calibration[0] + self.calibration[1] * _logit(mean))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _logit(p):
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def minimise(f, x: np.ndarray, steps: int = 80, memory: int = 8) -> np.ndarray:
    """Limited-memory BFGS with backtracking for a smooth convex ``f`` -> (value, gradient)."""
    value, grad = f(x)
    s, y = [], []
    for _ in range(steps):
        q, coef = grad.copy(), []
        for a, b in zip(reversed(s), reversed(y)):
            c = a @ q / (b @ a)
            coef.append(c)
            q -= c * b
        q *= (s[-1] @ y[-1]) / (y[-1] @ y[-1]) if s else 1 / max(1.0, float(np.abs(grad).sum()))
        for (a, b), c in zip(zip(s, y), reversed(coef)):
            q += (c - b @ q / (b @ a)) * a
        step = 1.0
        while step > 1e-8:
            new_value, new_grad = f(x - step * q)
            if new_value <= value - 1e-4 * step * float(q @ grad):
                break
            step /= 2
        else:
            return x
        if float((new_grad - grad) @ (-step * q)) > 1e-12:
            s.append(-step * q)
            y.append(new_grad - grad)
        s, y = s[-memory:], y[-memory:]
        x = x - step * q
        if value - new_value < 1e-7 * max(1.0, abs(value)):
            return x
        value, grad = new_value, new_grad
    return x


def logistic(x: np.ndarray, label: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weighted ridge logistic regression; ``x`` has its own constant column."""
    total = weight.sum()

    def loss(b):
        z = x @ b
        value = (weight * (np.logaddexp(0, z) - label * z)).sum() / total + ridge * float(b @ b) / 2
        return value, x.T @ (weight * (_sigmoid(z) - label)) / total + ridge * b

    return minimise(loss, np.zeros(x.shape[1]), 200)


def fit(features: np.ndarray, size: np.ndarray, first: np.ndarray, label: np.ndarray, weight: np.ndarray,
        ridge: float = 1e-4) -> LineModel:
    """Train on documents: ``label`` and ``weight`` per document, lines bounded by ``first``."""
    length = np.diff(first)
    line_doc = np.repeat(np.arange(len(label)), length)
    gold = label[line_doc].astype(np.int64)
    # documents count alike, however many lines they have
    chain = weight / np.sqrt(length)
    chain = chain / chain.sum()
    groups = [np.flatnonzero(label == c) for c in (0, 1)]
    model = None
    x = np.zeros(features.shape[1] + 4)
    inner = np.flatnonzero(line_doc[1:] == line_doc[:-1])
    per_line = chain[line_doc]
    levels = np.unique(chain)
    if len(levels) > 64:  # chain weights in 64 steps, so that chains of one weight share a pass
        edges = np.quantile(chain, np.linspace(0, 1, 65))
        chain = edges[np.clip(np.searchsorted(edges, chain, side="right") - 1, 0, 63)]
        per_line, levels = chain[line_doc], np.unique(chain)
    parts = []
    for v in levels:
        docs = np.flatnonzero(chain == v)
        lines = np.concatenate([np.arange(first[d], first[d + 1]) for d in docs])
        parts.append((v, lines, np.concatenate(([0], np.cumsum(length[docs])))))
    for turn in range(EM_ROUNDS + 1):
        seen = np.zeros((2, 2))
        np.add.at(seen, (gold[inner], gold[inner + 1]), per_line[inner])

        def loss(v):
            w, trans = v[:-4], v[-4:].reshape(2, 2)
            score = features @ w
            value = -float((per_line * gold * score).sum()) - float((seen * trans).sum())
            g_line, pair = np.empty(len(score)), np.zeros((2, 2))
            for c, lines, bounds in parts:
                good, expected, log_z = marginals(score[lines], bounds, trans)
                g_line[lines] = good
                pair += c * expected
                value += c * log_z
            grad = np.concatenate([features.T @ (per_line * (g_line - gold)), (pair - seen).ravel()])
            return value + ridge * float(v @ v) / 2, grad + ridge * v

        x = minimise(loss, x, 60 if turn == 0 else 25)
        model = LineModel(x[:-4], x[-4:].reshape(2, 2), np.array([0.0, 1.0]))
        if turn == EM_ROUNDS:
            break
        good = model.line_marginals(features, first)
        for d in groups[0]:
            lines = np.arange(first[d], first[d + 1])
            clean = good[lines] > 0.9
            if clean.sum() * 2 < len(lines):  # a bad document keeps at least half of its lines bad
                gold[lines] = clean
    good = model.line_marginals(features, first)
    mean = np.add.reduceat(good * size, first[:-1]) / np.add.reduceat(size, first[:-1])
    model.calibration = logistic(np.stack([np.ones(len(mean)), _logit(mean)], axis=1), label, weight)
    return model


# --- Spark ----------------------------------------------------------------------------------------
def _sample_features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = WordHasher(space_words(), lower=True)
    for batch in batches:
        for lo, hi, data, offs in text_chunks(batch.column("text")):
            f, size, first = line_features(hasher, data, offs)
            keep = [i for i in range(hi - lo) if first[i + 1] - first[i] <= MAX_LINES]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").slice(lo, hi - lo).take(pa.array(keep, pa.int64())),
                batch.column("label").slice(lo, hi - lo).take(pa.array(keep, pa.int64())),
                pa.array([f[first[i]:first[i + 1]].astype(np.float32).tobytes() for i in keep], pa.binary()),
                pa.array([size[first[i]:first[i + 1]].tobytes() for i in keep], pa.binary()),
            ], names=["doc_id", "label", "f", "size"])


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> LineModel:
    sample, sizes = labelled_sample(docs, labels, "quality", per_class)
    sample = sample.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "label")
    # line counts of the drawn documents (2 * per_class rows at most) until the bound is reached, both classes alike
    lines = sample.select("doc_id", "label", F.size(F.split(F.coalesce("text", F.lit("")), "\n")).alias("n")).filter(F.col("n") <= MAX_LINES)
    so_far = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id")
    fits = lines.withColumn("n", F.sum("n").over(so_far)).filter(F.col("n") <= SAMPLE_LINES // 2).select("doc_id")
    rows = sample.join(F.broadcast(fits), "doc_id", "left_semi") \
        .mapInArrow(_sample_features, "doc_id long, label int, f binary, size binary").toPandas()
    if rows.empty or rows["label"].nunique() < 2:
        constant = 0.5 if rows.empty else float(rows["label"].iloc[0])
        return LineModel(np.zeros(N_FEATURES), np.zeros((2, 2)), np.zeros(2), constant)
    rows = rows.sort_values(["doc_id", "label", "f"], kind="stable")
    features = [np.frombuffer(f, dtype=np.float32).reshape(-1, N_FEATURES) for f in rows["f"]]
    first = np.concatenate(([0], np.cumsum([len(f) for f in features])))
    label = rows["label"].to_numpy(dtype=np.float64)
    drawn = {c: max(1, int((label == c).sum())) for c in (0, 1)}
    weight = np.where(label == 1, sizes.get(1, 1) / drawn[1], sizes.get(0, 1) / drawn[0])
    return fit(np.concatenate(features).astype(np.float64), np.concatenate([np.frombuffer(s) for s in rows["size"]]),
               first, label, weight)


def score_quality(docs: DataFrame, model: LineModel, name: str = "quality_score") -> DataFrame:
    """``docs`` with the probability of label 1 in column ``name`` (which replaces one of that name)."""
    rest = [c for c in docs.columns if c != name]
    kept = docs.select(*[F.col(f"`{c}`") for c in rest])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        hasher = WordHasher(space_words(), lower=True)
        for batch in batches:
            for lo, hi, data, offs in text_chunks(batch.column("text")):
                got = shared.value.document_scores(*line_features(hasher, data, offs))
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(got, pa.float64())],
                                                 names=[*part.schema.names, name])

    schema = T.StructType([*kept.schema.fields, T.StructField(name, T.DoubleType())])
    return kept.mapInArrow(score, schema)


def keep_good(docs: DataFrame, labels: DataFrame, reject_below: float = REJECT_BELOW) -> DataFrame:
    """``docs`` without the documents whose score is below ``reject_below``; all columns are kept."""
    score = free_name(docs, "_quality")
    return score_quality(docs, train(docs, labels), score).filter(F.col(score) >= reject_below).select(*docs.columns)
