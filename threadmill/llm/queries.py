"""The registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from threadmill.llm import (
    language, leaks, mixing, nearjoin, negatives, packing, personal, quality, repeats, tokens, urls, vectors, whitening,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.piece_digests(packing.pack(_table(spark, sf_dir, "documents")))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(_table(spark, sf_dir, "pages"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.span_digests(personal.personal_spans(_table(spark, sf_dir, "documents")))


def op5_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(_table(spark, sf_dir, "embeddings"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearjoin.near_documents(_table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(_table(spark, sf_dir, "documents"))


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_digests(repeats.remove_repeats(_table(spark, sf_dir, "documents")))


def op9_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.leaked_passages(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return quality.score_quality(docs, quality.train(docs, labels))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_packing, op2_language_id, op3_url_filters, op4_personal_data, op5_near_vectors, op6_jaccard_join,
        op7_token_counts, op8_repeats, op9_benchmark_leaks, op10_quality, op11_hard_negatives,
        op12_source_mix, op13_whitening,
    )
}
