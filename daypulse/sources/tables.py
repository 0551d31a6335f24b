"""Batch scans.

Predicates are plain column comparisons on the stored columns, so Catalyst
turns them into Parquet filter pushdown or, on ``date``-partitioned tables,
partition pruning.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daypulse.operators.geo import valid_range

_OPS = {
    "=": lambda c, v: c == v, "==": lambda c, v: c == v, "!=": lambda c, v: c != v,
    "<": lambda c, v: c < v, "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v, ">=": lambda c, v: c >= v,
}


def date_predicate(date_col: str, op: str, day) -> Column:
    """``date_col <op> DATE 'day'`` — a typed date literal, never text."""
    if op not in _OPS:
        raise ValueError(f"unsupported operator {op!r}")
    return _OPS[op](F.col(date_col), F.lit(str(day)).cast("date"))


def scan(spark: SparkSession, path: str, op: str | None = None, day=None,
         date_col: str = "date", fmt: str = "parquet", columns=None) -> DataFrame:
    """File scan with an optional date predicate (pruned/pushed)."""
    df = spark.read.format(fmt).load(path)
    if op is not None:
        df = df.filter(date_predicate(date_col, op, day))
    return df.select(*columns) if columns else df


def scan_table(spark: SparkSession, name: str, op: str | None = None, day=None,
               date_col: str = "date") -> DataFrame:
    """The same over a catalog table."""
    df = spark.table(name)
    return df.filter(date_predicate(date_col, op, day)) if op is not None else df


def ts_day_range(df: DataFrame, ts_col: str, first_day: str, last_day: str) -> DataFrame:
    """Rows whose ``timestamp_ntz`` falls on days first..last (inclusive),
    written as bounds on the raw column so they reach the Parquet scan."""
    lo = _dt.date.fromisoformat(first_day)
    hi = _dt.date.fromisoformat(last_day) + _dt.timedelta(days=1)
    ts = F.col(ts_col)
    return df.filter((ts >= F.lit(f"{lo} 00:00:00").cast("timestamp_ntz"))
                     & (ts < F.lit(f"{hi} 00:00:00").cast("timestamp_ntz")))


def read_headered_csv(spark: SparkSession, path: str, schema: T.StructType,
                      renames: dict | None = None) -> DataFrame:
    """Headered CSV with an explicit schema (no inference pass)."""
    df = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)
    for old, new in (renames or {}).items():
        df = df.withColumnRenamed(old, new)
    return df


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A zero-row frame of the given schema (to pre-create a table)."""
    return spark.createDataFrame([], schema)


GEO_CSV_SCHEMA = T.StructType([
    T.StructField("StartIPNum", T.StringType()),
    T.StructField("EndIPNum", T.StringType()),
    T.StructField("Country", T.StringType()),
    T.StructField("Local", T.StringType()),
])


def geo_from_csv(spark: SparkSession, path: str) -> DataFrame:
    """S8 for the geo dimension: bounds cast to long, columns renamed;
    rows with a missing or non-numeric bound, or one that is no IPv4 range, are
    dropped (:func:`rejected_geo_rows` gives them)."""
    raw = read_headered_csv(spark, path, GEO_CSV_SCHEMA)
    return (raw.select(F.col("StartIPNum").try_cast("bigint").alias("start_ip"),
                       F.col("EndIPNum").try_cast("bigint").alias("end_ip"),
                       F.col("Country").alias("country"), F.col("Local").alias("local_city"))
            .filter(valid_range()))


def rejected_geo_rows(spark: SparkSession, path: str) -> DataFrame:
    """The CSV rows that :func:`geo_from_csv` drops, as text."""
    raw = read_headered_csv(spark, path, GEO_CSV_SCHEMA)
    bounds = raw.select("*", F.col("StartIPNum").try_cast("bigint").alias("start_ip"),
                        F.col("EndIPNum").try_cast("bigint").alias("end_ip"))
    return bounds.filter(~valid_range()).select(*GEO_CSV_SCHEMA.names)


def load_or_build_geo(spark: SparkSession, csv_path: str, table_path: str,
                      force: bool = False) -> DataFrame:
    """If forced or missing, build the dimension from CSV and write
    it; then read the stored table (null bounds always filtered)."""
    from daypulse.sinks.tables import path_exists, write_table
    if force or not path_exists(spark, table_path):
        write_table(geo_from_csv(spark, csv_path), table_path, mode="overwrite")
    stored = spark.read.parquet(table_path)
    return stored.filter(F.col("start_ip").isNotNull() & F.col("end_ip").isNotNull())
