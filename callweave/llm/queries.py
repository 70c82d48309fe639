"""Registered queries of the training-data operators (``opN_<name>``) and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callweave.llm import circulant, decontam, fim, fixity, mixing, packing, pii, pq, quality_crf, quality_llr, rlz, sharding, toxicity
from callweave.llm.common import documents, held_out, read_columns, table


def op1_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_columns(documents(spark, sf_dir), "doc_id", "text")
    model = quality_crf.train(docs, table(spark, sf_dir, "labels"))
    return quality_crf.score_quality(docs, model, "score").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= quality_crf.REJECT_BELOW).cast("int").alias("predicted"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir), 8)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_columns(documents(spark, sf_dir), "doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model, "score").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.TOXIC_FROM).cast("int").alias("predicted"))


def op5_quality_llr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_llr.quality_verdicts(documents(spark, sf_dir))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(documents(spark, sf_dir))


def op7_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return circulant.near_duplicate_classes(documents(spark, sf_dir)) \
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(documents(spark, sf_dir)) \
        .select("doc_id", "size", "source_size", "target", "taken")


def op9_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return fixity.audit(fixity.warc_records(pages), fixity.warc_records(fixity.damaged_replica(pages)))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"), stretch=decontam.STRETCH)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated", "n_near")


def fim_digests(docs: DataFrame) -> DataFrame:
    """Digests of every document's transformed text and of the text rebuilt from it."""
    done = fim.restore_documents(fim.transform_documents(docs))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim_digests(documents(spark, sf_dir))


def op12_rlz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rlz.remove_repeats(documents(spark, sf_dir)) \
        .select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op13_pq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq.quantise(table(spark, sf_dir, "embeddings")) \
        .select("vec_id", "code", "error", "label_error", "codebooks_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_crf": op1_quality_crf,
    "op2_sharding": op2_sharding,
    "op3_packing": op3_packing,
    "op4_toxicity": op4_toxicity,
    "op5_quality_llr": op5_quality_llr,
    "op6_pii": op6_pii,
    "op7_circulant_minhash": op7_circulant_minhash,
    "op8_mixing": op8_mixing,
    "op9_warc_fixity": op9_warc_fixity,
    "op10_decontamination": op10_decontamination,
    "op11_fim": op11_fim,
    "op12_rlz": op12_rlz,
    "op13_pq": op13_pq,
}
