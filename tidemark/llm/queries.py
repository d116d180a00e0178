"""The registered queries of the numbered operators: whole tables in, the agreed columns out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.oracle import SQL  # noqa: F401  (SQL twins, where SQL can say it)
from tidemark.llm import (
    automaton_dedup, chat_repair, decontaminate, filter_audit, hilbert_clusters, jaccard_join, license_scan, prefix_forest, source_mix, suffix_dedup,
    super_minhash, token_files, weak_quality,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = weak_quality.judge_quality(table(spark, sf_dir, "documents").select("doc_id", "text"), "quality")
    return judged.select("doc_id", "quality.*")


def removed() -> Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])


@query
def op2_automaton_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = automaton_dedup.remove_repeated_words(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.col("n_units").alias("n_words"), removed().alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_table(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op4_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_repair.repair_chats(table(spark, sf_dir, "conversations"))


@query
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeated_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", F.col("n_units").alias("n_bytes"), removed().alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


@query
def op6_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return prefix_forest.nearest_neighbours(vectors, vectors.filter("vec_id % 20 = 0"))


@query
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.counted_documents(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("tkey")


@query
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"), "found")
    return found.select(
        "doc_id", "found.n_words", "found.n_hit", F.size("found.item_ids").cast("long").alias("n_items"),
        decontaminate.items_digest("found").alias("items_sha256"), decontaminate.contaminated("found").alias("contaminated"))


@query
def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = source_mix.mix_documents(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"), F.col("mix_taken").alias("taken"))


@query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"), "found")
    return found.select("doc_id", "found.*")


@query
def op11_super_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return super_minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("tkey")


@query
def op12_hilbert_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_clusters.cluster_vectors(table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector")))


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
