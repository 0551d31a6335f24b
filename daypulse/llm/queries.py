"""One query for each operator of this subpackage, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypulse.llm import (conversation_repair, hamming_search, hard_negatives, language_id, license_scan, mixing, oracles, packing,
                          quality, simhash, token_files, url_filter, vector_dedup, window_packing)
from daypulse.llm.storage import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, _table(spark, sf_dir, "labels")), ["doc_id"])


def op2_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixing.mix(_table(spark, sf_dir, "documents"), entropy=0.95, max_repetition=4.0)
    return drawn.select("doc_id", "source", "mix_epoch", "mix_block", "mix_key")


def op3_url_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op4_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), hamming_search.sign_code(F.col("embedding")).alias("code"))
    return hamming_search.top_k(rows, rows.where("id % 50 = 0"), k=10)


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_classes(_table(spark, sf_dir, "documents"), ["doc_id"], shingle=3, max_bits=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(_table(spark, sf_dir, "documents"), path, end_id=0)
    return token_files.digest(spark, path)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op8_nearest_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", language_id.held_out(F.col("doc_id")))
    model = language_id.fit(docs.where("NOT held_out"))
    return language_id.predict(docs, model, ["doc_id", "held_out"])


def op9_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"), least=0.95)


def op10_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), capacity=1024, end_id=2)


def op11_sum_of_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_packing.pack_windows(_table(spark, sf_dir, "documents"), capacity=4096, end_id=2)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations")
    report = conversation_repair.repair(conversation_repair.damage(rows)).report().withColumnRenamed("conv_id", "found")
    ids = rows.select("conv_id").distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return ids.join(report, ids.conv_id.eqNullSafe(report.found), "left").select(
        "conv_id", *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("id") % 50 == 0, positives=5, negatives=3, least=0.5,
                               most=0.95, scale=256.0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_co_training, op2_temperature_mixing, op3_url_language_model, op4_multi_index_hashing, op5_simhash_dedup,
        op6_token_files, op7_license_scan, op8_nearest_centroid, op9_vector_dedup, op10_best_two_fit, op11_sum_of_squares,
        op12_conversation_repair, op13_hard_negatives)}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of those that SQL expresses."""
    return oracles.oracle_sql()
