"""The text operators as named queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from wayfact.llm import (
    bpe,
    chunk_dedup,
    decontaminate,
    importance,
    licences,
    minhash,
    phrases,
    pu_quality,
    quality_rules,
    simhash,
    token_files,
    toxicity,
    url_filter,
)
from wayfact.llm.common import table

TOKENIZER = "word_bpe_49k.json"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality_rules.STATS, "base_failed", "kept")


@query
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(table(spark, sf_dir, "pages"))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "held_out", "score", "predicted")


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.benchmark_matches(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.repeated_passages(table(spark, sf_dir, "documents"))


@query
def op6_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_quality.pu_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licences(table(spark, sf_dir, "documents"))


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


@query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    files = token_files.write_token_files(docs, public_tokenizers.path(TOKENIZER))
    return token_files.read_token_files(files)


def token_digests(docs: DataFrame) -> DataFrame:
    coded = bpe.transcode(docs, public_tokenizers.path(TOKENIZER))
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))


@query
def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.minhash_components(table(spark, sf_dir, "documents"))


@query
def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query
def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.importance_resampling(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)
