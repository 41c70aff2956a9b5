"""One query per operator over its whole table, and the checking SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factorfall.llm import (
    chat_format,
    exact_topk,
    host_rules,
    kneser_ney,
    packing,
    pivot_dedup,
    secret_scan,
    simhash_bktree,
    source_divergence,
    source_mixing,
    spelling_variants,
    toxicity,
    url_filters,
)
from factorfall.llm.checking_sql import checking_sql
from factorfall.llm.common import given, ship


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = given(spark, sf_dir, "pages")
    found = url_filters.filter_urls(url_filters.dated_captures(pages), url_filters.dated_entries(pages))
    return found.withColumn("fetched_on", F.col("fetched_on").cast("string"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = source_mixing.mixed(given(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "source",
        *[F.col(f"mix_{c}").alias(c) for c in ("tokens", "weight", "epoch", "block", "block_order", "doc_order")],
    )


def op3_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.host_rules(given(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(given(spark, sf_dir, "documents"), given(spark, sf_dir, "labels"))


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(given(spark, sf_dir, "embeddings"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(given(spark, sf_dir, "documents"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = given(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    ok = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", ok), (-1, 1, "assistant", ok)], "conv_id long, turn long, role string, text string")
    return chat_format.chat_digest(turns.unionByName(probe))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digest(given(spark, sf_dir, "documents"))


def op9_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_bktree.near_duplicates(given(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op10_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.quality_by_perplexity(given(spark, sf_dir, "documents"), given(spark, sf_dir, "labels"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(given(spark, sf_dir, "documents"))


def op12_pivot_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_dedup.near_vectors(given(spark, sf_dir, "embeddings"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.source_divergence(given(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(ship(spark), sf_dir)


OPERATORS = (
    op1_url_filters, op2_source_mixing, op3_host_rules, op4_toxicity, op5_exact_topk, op6_packing, op7_chat_format,
    op8_secret_scan, op9_simhash_bktree, op10_kneser_ney, op11_spelling_variants, op12_pivot_dedup, op13_source_divergence, pipeline,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in OPERATORS}


def oracle_sql() -> dict[str, str]:
    return checking_sql()
