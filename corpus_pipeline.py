"""A training corpus from ``documents``: five stages, each one operator of
``daypulse.llm``, each over all that its predecessor kept.

Every stage is a function (spark, docs, sf_dir) -> DataFrame; ``run`` writes its
result as Parquet in the shared scratch folder and hands the reread table to the
next. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypulse.llm import language_id, mixing, packing, quality, simhash
from daypulse.llm.storage import materialise


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts of a known language stay; what is like none of them goes."""
    model = language_id.fit(docs.where(~language_id.held_out(F.col("doc_id"))))
    return language_id.keep_known(docs, model)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class stays."""
    return simhash.deduplicate(docs, shingle=3, max_bits=2)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by their tempered weights; a document is there once for each
    epoch that draws it."""
    return mixing.mix(docs, entropy=0.95, max_repetition=4.0).select(*docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids and their places in sequences of 1,024."""
    return packing.pack(docs, capacity=1024, end_id=2)


STAGES = [("language_id", language), ("quality", quality_filter), ("simhash_dedup", near_duplicates),
          ("mixing", mixture), ("packing", sequences)]

#: Trained models and 64-bit hashes are not for SQL: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
