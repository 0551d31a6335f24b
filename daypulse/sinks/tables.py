"""Table writes (K1-K6, K8).

One ``write_table`` for paths and catalog tables; ``partition_by`` is always
honoured, and overwrites of a partitioned target replace only the touched
partitions (``partitionOverwriteMode=dynamic``), so re-running one day is
idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def is_path(target: str) -> bool:
    return "/" in target or ":" in target


def write_table(df: DataFrame, target: str, partition_by=None, mode: str = "append",
                fmt: str = "parquet") -> None:
    """K1/K2/K3: write to a path (``/…``, ``scheme:…``) or a catalog table.
    ``overwrite`` of a partitioned target replaces the partitions that ``df``
    brings; ``replace`` replaces the whole target."""
    writer = df.write.mode("overwrite" if mode == "replace" else mode).format(fmt)
    if partition_by:
        cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
        writer = writer.partitionBy(*cols)
    if mode == "overwrite" and partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if mode == "replace":
        writer = writer.option("partitionOverwriteMode", "static")
    if is_path(target):
        writer.save(target)
    elif mode == "overwrite" and partition_by and df.sparkSession.catalog.tableExists(target):
        # saveAsTable would replace the whole table; insertInto replaces the partitions it brings
        spark = df.sparkSession
        key = "spark.sql.sources.partitionOverwriteMode"
        before = spark.conf.get(key, None)
        spark.conf.set(key, "dynamic")
        try:
            df.select(*spark.table(target).columns).write.insertInto(target, overwrite=True)
        finally:
            spark.conf.set(key, before) if before is not None else spark.conf.unset(key)
    else:
        writer.saveAsTable(target)


def write_bucketed(df: DataFrame, table: str, keys, buckets: int, sort_by=None) -> None:
    """K2: a catalog table whose files are dealt by a hash of ``keys`` and
    sorted by them. Joins and aggregates of such tables by these keys (J2, A8,
    A10) need no shuffle: the deal is made once, when the table is written.
    The rows are dealt before they are written, so a bucket is one file."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    sort = list(sort_by or keys)
    (df.repartition(buckets, *keys).sortWithinPartitions(*sort).write.mode("overwrite").format("parquet")
     .bucketBy(buckets, *keys).sortBy(*sort).saveAsTable(table))


def read_table(spark: SparkSession, target: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(target) if is_path(target) else spark.table(target)


def path_exists(spark: SparkSession, target: str) -> bool:
    """Whether a path or catalog table exists (no file is opened; a folder
    without rows exists too)."""
    if not is_path(target):
        return spark.catalog.tableExists(target)
    from pyspark.errors import AnalysisException
    try:
        spark.read.schema("_any int").parquet(target)
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def drop_target(spark: SparkSession, target: str) -> None:
    """K5: drop a catalog table; for paths, overwrite mode replaces data."""
    if is_path(target):
        raise ValueError("paths are replaced with mode='overwrite', not deleted")
    spark.sql(f"DROP TABLE IF EXISTS {target}")


def write_and_check(df: DataFrame, target: str, partition_by=None, mode: str = "append",
                    expected_rows: int | None = None) -> int:
    """K4/K6: write, then read back and count (a separate, cheap job on the
    written files). Raises when ``expected_rows`` is given and differs."""
    spark = df.sparkSession
    write_table(df, target, partition_by, mode)
    n = read_table(spark, target).count()
    if expected_rows is not None and n != expected_rows:
        raise AssertionError(f"{target}: {n} rows read back, expected {expected_rows}")
    return n


def save_and_preview(df: DataFrame, target: str, partition_by=None, mode: str = "append",
                     n: int = 20) -> DataFrame:
    """K4: write, then return the first ``n`` rows *of the written table*
    (a cheap limited scan; the frame is not recomputed)."""
    write_table(df, target, partition_by, mode)
    return read_table(df.sparkSession, target).limit(n)


def to_json_rows(df: DataFrame, value_col: str = "value") -> DataFrame:
    """K8: each row as one JSON object (executor-side; null fields omitted).

    ``df.write.format("kafka")`` of this frame replaces the driver-side
    producer; it is written to text in tests (no broker here)."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias(value_col))


def publish_json_rows(df: DataFrame, servers: str, topic: str, options: dict | None = None) -> None:
    """K8: write every row as a JSON message to a Kafka topic from the
    executors (needs the Kafka connector on the cluster's classpath)."""
    writer = (to_json_rows(df).write.format("kafka")
              .option("kafka.bootstrap.servers", servers).option("topic", topic))
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    writer.save()
