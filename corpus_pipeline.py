"""From raw documents to token ids: the stages of a training-data pipeline.

Each stage is written as Parquet and reread as the next one's documents, so that a lost
executor costs a stage's tasks at most. All stages but the last return the columns of
``documents``; the last one returns ids and their digests.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm import bpe, contamination, pii, quality, similar
from tickerloom.plans.durable import shared_folder

#: Word shingles and similarity of the near-duplicate stage.
SHINGLE = 5
PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the adaptive quality rules."""
    return quality.quality_filter(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return similar.keep_one(docs, SHINGLE, PERCENT)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return contamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind and lengths to match."""
    masked = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return masked
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return masked.withColumn("n_chars", F.coalesce(length, F.col("n_chars")))


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, checked by decoding them."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.bpe_digests(docs, ranks, public_tokenizers.PATTERN, keep_ids=True, share=4)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii", pii_masking),
    ("byte_level_bpe", byte_level_bpe),
]

#: SQL has no quantile sketch that gives the same limits, no transitive closure at this
#: size and no byte-pair merges; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; intermediate tables go to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
