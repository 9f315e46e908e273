"""The training-data pipeline over ``documents``: five stages, each a written
table that the next one reads.

1. language ID: texts without a language, or with no language that has half of
   their words, go;
2. quality classifier: texts below the score threshold go;
3. n-gram Jaccard join: of each group of near-duplicates the smallest id stays;
4. benchmark decontamination: texts that hold a benchmark item go;
5. BPE: token ids and digests of what is left.

Stages 1, 2 and 4 judge rows where they stand and shuffle no text. Rows with a
null id stay in stage 3 (they cannot be named by another row's group). It judges
rows, not ids: rows of one id with different texts are in groups of their own; of
several rows with one id and equal sets one stays, that of the smallest hash.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgestat.llm import bpe, language_id, quality
from forgestat.llm.common import saved, table
from forgestat.llm.decontaminate import decontaminated
from forgestat.llm.ngram_join import BROADCAST_IDS, ngram_components
from forgestat.session import checkpoint_dir


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.identified(docs, language_id.fit_languages(docs), least=0.5)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.quality_kept(docs, table(spark, sf_dir, "labels"), threshold=0.3)


def ngram_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    again = docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1")
    if again.isEmpty():
        rows, node = docs, "doc_id"
        # what goes: every row that is not the first of its group
        gone = ngram_components(docs).filter("doc_id is not null and component_id <> doc_id").select("doc_id")
    else:
        # ids do not tell the rows apart; numbers written once do, under a name that docs do not use
        node = "_row" + "_" * max(map(len, docs.columns))
        rows = saved(docs.withColumn(node, F.when(F.col("doc_id").isNotNull(), F.monotonically_increasing_id())), "rows")
        groups = saved(ngram_components(rows, id_col=node).filter("doc_id is not null").select(
            F.col("doc_id").alias(node), (F.col("n_shingles") == 0).alias("empty"), F.col("component_id").alias("part")), "groups")
        names = rows.filter(F.col(node).isNotNull()).select(node, "doc_id", F.xxhash64(*docs.columns).alias("hash"))
        # texts without words are in no group: those of one id are one
        own = saved(groups.join(names, node).withColumn("part", F.when(F.col("empty"), F.col("doc_id").cast("long")).otherwise(F.col("part"))),
                    "own")
        first = own.groupBy("empty", "part").agg(F.min(F.struct("doc_id", "hash", node)).alias("x")).select(f"x.{node}")
        gone = own.select(node).join(first, node, "left_anti")
    gone = saved(gone, "gone")
    few = gone.count() <= BROADCAST_IDS
    return rows.join(F.broadcast(gone) if few else gone, node, "left_anti").select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = bpe.bpe_encode(docs, bpe.public_tokenizer())
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("language_id", language_stage), ("quality_classifier", quality_stage), ("ngram_jaccard_join", ngram_stage),
          ("benchmark_decontamination", decontamination_stage), ("bpe_encoding", bpe_stage)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    root = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
