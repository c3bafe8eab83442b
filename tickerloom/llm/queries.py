"""The registered queries of the operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
import public_tokenizers
from tickerloom.llm import (
    bpe,
    centroids,
    chat,
    contamination,
    html,
    lm,
    negatives,
    pii,
    quality,
    simhash,
    similar,
    substrings,
    suffixes,
)
from tickerloom.llm.sql import ORACLES  # noqa: F401  (read by __spark_entry__)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str) -> Callable:
    def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name] = fn
        return fn

    return register


@query("op8_pii")
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digests(_table(spark, sf_dir, "documents"))


@query("op9_quality_rules")
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(_table(spark, sf_dir, "documents")).drop("text_hash")


@query("op4_chat_format")
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema
    )
    return chat.chat_digests(chat.format_chat(rows.unionByName(extra)))


@query("op5_html_extraction")
def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(_table(spark, sf_dir, "pages"))


@query("op6_byte_bpe")
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.bpe_digests(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@query("op7_substring_dedup")
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_digests(_table(spark, sf_dir, "documents"))


@query("op2_benchmark_decontamination")
def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.judged(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


@query("op3_ngram_jaccard_join")
def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = similar.linked(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", rows["n"].alias("n_shingles"), "component_id")


@query("op10_suffix_array_dedup")
def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.dedup_digests(_table(spark, sf_dir, "documents"))


@query("op1_lm_scoring")
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    subwords = lm.Subwords(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return lm.scored(_table(spark, sf_dir, "documents"), subwords)


@query("op11_hard_negatives")
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mined(_table(spark, sf_dir, "embeddings"))


@query("op12_centroid_clustering")
def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(_table(spark, sf_dir, "embeddings"))


@query("op13_simhash_near_dedup")
def op13_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.linked(_table(spark, sf_dir, "documents"))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir).drop("ids")
