"""The operators' registered queries, over their whole tables, and their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgestat.llm import bit_sliced, bpe, chat_format, divergence, license_scan, manifest, ngram_join
from forgestat.llm.cap_filters import near_vectors
from forgestat.llm.common import table
from forgestat.llm.decontaminate import contaminations
from forgestat.llm.language_id import fit_languages, identify
from forgestat.llm.lm_score import word_scores
from forgestat.llm.quality import quality_scores
from forgestat.llm.sharding import shard_by_bytes


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"), num=75, den=100)


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise(chat_format.ASSISTANT).alias("role"),
                                  F.lit(chat_format.PROBE).alias("text"))
    return chat_format.digests(chat_format.chat_examples(rows.unionByName(probe)))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_scores(table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents")).drop("places")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit_languages(docs))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(table(spark, sf_dir, "documents"), 40)


def op8_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.9)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.bpe_encode(table(spark, sf_dir, "documents"), bpe.public_tokenizer()))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def op11_bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_sliced.top_inner_products(table(spark, sf_dir, "embeddings"), k=5, every=50)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"), least=10, best=10)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.merkle_manifest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_decontamination, op2_ngram_jaccard, op3_chat_format, op4_lm_score, op5_license_scan,
                            op6_language_id, op7_sharding, op8_cap_filters, op9_bpe, op10_quality,
                            op11_bit_sliced_top_k, op12_source_divergence, op13_merkle_manifest)}

ORACLE_SQL: dict[str, str] = {
    "op3_chat_format": chat_format.oracle_sql(), "op5_license_scan": license_scan.oracle_sql(),
    "op11_bit_sliced_top_k": bit_sliced.oracle_sql(), "op12_source_divergence": divergence.oracle_sql(),
    "op13_merkle_manifest": manifest.oracle_sql()}
