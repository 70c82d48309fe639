"""Corpus pipeline: quality classifier, near-duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the
last return the columns of ``documents``.  ``run`` writes every stage's result as Parquet into
the shared folder (``spark.checkpoint.dir``) and reads it again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from callweave.llm import circulant, decontam, mixing, quality_crf, sharding
from callweave.llm.common import documents, materialize, table

SHARDS = 8


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line CRF rejects go."""
    return quality_crf.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, 0.8) stays: that of the smallest doc_id."""
    return circulant.deduplicate(docs, circulant.FIVE_WORDS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages go."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: none to three times."""
    return mixing.apply_mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document of the mix."""
    return sharding.shard_documents(docs, SHARDS)


STAGES = [
    ("quality classifier", quality),
    ("near-duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: the classifier is trained, which SQL cannot express; see tests/llm for the brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
