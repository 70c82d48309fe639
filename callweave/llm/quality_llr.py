"""Quality rules: base text rules and a hashed n-gram log-likelihood ratio, in DataFrame
functions only.

The verdict compares two multinomials over hashed words and word pairs: the trusted target
(documents that pass strict structural rules) and the raw corpus (all documents).  A
document's score is the mean log ratio of its n-grams, so length does not matter; documents
below ``THRESHOLD`` are not kept.  Every n-gram of every document counts, in both corpora.

Words: `[^\\x20\\x09-\\x0D]+`.  Every column that is read by more than one expression is made
in its own projection, so the text is split once.

Defined results: a null or empty text has no words, fails the base rule and is not kept;
repeated rows give repeated results; an empty table gives an empty result; extra columns are
ignored; no trusted document at all means equal multinomials (score 0 everywhere).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.llm.common import materialize, read_columns, space_word_array

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SPAN = 8
#: hash buckets of words and of word pairs each
BUCKETS = 1 << 14
#: mean log ratio below which a document is not kept
THRESHOLD = -0.15
#: pseudo-count of every bucket
PRIOR = 1.0


def _pairwise(a: Column, gap: int) -> Column:
    """hash(a[i], a[i + gap]); the last ``gap`` entries have no partner and are to be cut off."""
    return F.zip_with(a, F.slice(a, F.lit(gap + 1), F.greatest(F.size(a) - gap, F.lit(0))),
                      lambda x, y: F.xxhash64(x, y))


def _head(a: Column, n: Column) -> Column:
    return F.slice(a, F.lit(1), F.greatest(n, F.lit(0)))


def _bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also inside nested lambdas."""
    return F.transform(F.array(value), body)[0]


def _covered(windows: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more."""
    def starts(s: Column) -> Column:
        def twin(x: Column, i: Column) -> Column:
            before, after = F.get(s, i - 1)["h"] == x["h"], F.get(s, i + 1)["h"] == x["h"]
            return F.when(F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False)), x["i"])
        return F.sort_array(F.filter(F.transform(s, twin), lambda p: p.isNotNull()))

    def total(p: Column) -> Column:
        after = F.slice(p, F.lit(2), F.greatest(F.size(p) - 1, F.lit(0)))
        steps = F.zip_with(p, after, lambda a, b: F.least(F.lit(SPAN), F.coalesce(b - a, F.lit(SPAN))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda acc, x: acc + x)

    tagged = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(
        _bind(F.sort_array(tagged), lambda s: _bind(starts(s), total)))


def word_hashes(docs: DataFrame) -> DataFrame:
    """doc_id, base counts, hashes of words (``_h``) and of pairs (``_p``, cut to the pairs)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda l: l.rlike("[^\\x20\\x09-\\x0D]"))
    words = read_columns(docs, "doc_id", "text").select(
        "doc_id", space_word_array(F.col("text")).alias("_w"), lines.alias("_l"),
        F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"))
    return words.select(
        "doc_id", F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"), "n_symbols",
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.transform("_w", lambda w: F.xxhash64(w)).alias("_h")) \
        .select("*", _pairwise(F.col("_h"), 1).alias("_p"))


def base_rules(hashed: DataFrame) -> DataFrame:
    """Adds n_repeat_words and base_failed."""
    n = F.size("_h")
    four = hashed.select("*", _pairwise(F.col("_p"), 2).alias("_q"))
    windows = four.select("*", _head(_pairwise(F.col("_q"), 4), n - (SPAN - 1)).alias("_win")).drop("_q")
    counted = windows.select("*", _covered(F.col("_win")).alias("n_repeat_words")).drop("_win")
    return counted.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def trusted(hashed: DataFrame) -> Column:
    """Strict structural rules of the target corpus, from columns of ``word_hashes``."""
    return ((F.col("n_words") >= 50) & (F.col("n_dup_lines") == 0)
            & (100 * F.col("n_symbols") <= F.col("n_words"))
            & (10 * F.size(F.array_distinct("_h")) >= 3 * F.col("n_words")))


def _buckets(hashes: Column, offset: int) -> Column:
    return F.transform(hashes, lambda h: (F.pmod(h, F.lit(BUCKETS)) + offset).cast("int"))


def _pairs(n: Column) -> Column:
    return _head(F.col("_p"), n - 1)


def log_ratios(docs: DataFrame) -> list[float]:
    """log(p_target / p_raw) of each bucket (words first, then pairs); a fixed 2 * BUCKETS numbers.

    Counts are aggregated on each side of the shuffle; at most 2 * BUCKETS rows reach the driver."""
    h = word_hashes(docs)
    # the flag and the buckets are made per document, below the explode; an outer explode keeps the
    # optimizer from testing the whole chain of expressions again in a filter on the scan
    grams = h.select(trusted(h).alias("t"), F.concat(
        _buckets(F.col("_h"), 0), _buckets(_pairs(F.size("_h")), BUCKETS)).alias("_b")) \
        .select("t", F.explode_outer("_b").alias("b")).filter("b IS NOT NULL")
    counts = grams.groupBy("b").agg(F.count(F.lit(1)).alias("raw"), F.sum(F.col("t").cast("long")).alias("target"))
    counts = materialize(counts, "gram_counts")
    kind = (F.col("b") >= BUCKETS).cast("int")
    totals = {r["k"]: (r["raw"], r["target"]) for r in counts.groupBy(kind.alias("k")).agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()}
    out = [0.0] * (2 * BUCKETS)
    share = [1.0, 1.0]
    for k, (raw, target) in totals.items():
        share[k] = (raw + PRIOR * BUCKETS) / (target + PRIOR * BUCKETS) if target else 0.0
    if not any(t for _, t in totals.values()):
        return out
    rows = counts.select("b", F.log((F.col("target") + PRIOR) / (F.col("raw") + PRIOR) * F.when(
        kind == 0, F.lit(share[0])).otherwise(F.lit(share[1]))).alias("v")).collect()
    for r in rows:
        out[r["b"]] = round(r["v"], 6)
    return out


def _score(weights: list[float]) -> Column:
    """Mean weight of a document's words and pairs; 0 without words."""
    table = F.from_json(F.lit("[" + ",".join(map(repr, weights)) + "]"), "array<double>")

    def total(hashes: Column, offset: int) -> Column:
        return F.aggregate(hashes, F.lit(0.0), lambda acc, h: acc + F.get(
            table, (F.pmod(h, F.lit(BUCKETS)) + offset).cast("int")))

    n = F.size("_h")
    grams = n + F.greatest(n - 1, F.lit(0))
    return F.when(n == 0, F.lit(0.0)).otherwise((total(F.col("_h"), 0) + total(_pairs(n), BUCKETS)) / grams)


def quality_verdicts(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, base counts, base_failed, llr (mean log ratio) and kept of every document."""
    weights = log_ratios(docs)
    rows = base_rules(word_hashes(docs))
    scored = rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", _score(weights).alias("llr"))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))
