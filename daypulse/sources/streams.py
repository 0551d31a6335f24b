"""Stream sources (S1, S2): log lines as a streaming ``value`` column.

Production reads Kafka; the connector jar is not part of this build, so
``source="text"`` reads a directory of text files with the same shape
(one log line per row) for tests and replays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_log_stream(spark: SparkSession, source: str = "kafka", *, topic: str | None = None,
                    servers: str | None = None, path: str | None = None,
                    from_start: bool = False, group_id: str | None = None,
                    max_per_trigger: int | None = None, fail_on_data_loss: bool = True,
                    options: dict | None = None) -> DataFrame:
    """S1 + S2: a streaming frame with one string column ``value``.

    ``from_start`` (the replay switch) reads from the earliest offsets;
    otherwise only new data. ``fail_on_data_loss=False`` lets the query go on
    when offsets have expired before they were read (those rows are lost). Keys and Kafka metadata are dropped.
    Credentials and other client settings go through ``options``.
    """
    if source == "kafka":
        reader = (spark.readStream.format("kafka")
                  .option("kafka.bootstrap.servers", servers)
                  .option("subscribe", topic)
                  .option("startingOffsets", "earliest" if from_start else "latest")
                  .option("failOnDataLoss", str(fail_on_data_loss).lower()))
        if group_id:
            reader = reader.option("kafka.group.id", group_id)
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        for k, v in (options or {}).items():
            reader = reader.option(k, v)
        return reader.load().select(F.col("value").cast("string").alias("value"))
    if source == "text":
        reader = spark.readStream.format("text")
        if max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_per_trigger)
        for k, v in (options or {}).items():
            reader = reader.option(k, v)
        return reader.load(path)
    raise ValueError(f"unknown source {source!r}")


def read_jdbc_query(spark: SparkSession, url: str, query: str, *, user: str | None = None,
                    password: str | None = None, partition_column: str | None = None,
                    lower_bound=None, upper_bound=None, num_partitions: int | None = None,
                    options: dict | None = None) -> DataFrame:
    """Run ``query`` in the database and read the result.

    With ``partition_column`` and bounds the read is split into
    ``num_partitions`` range queries (the reference read one partition).
    Credentials are passed only as options, never embedded in the URL.
    """
    reader = spark.read.format("jdbc").option("url", url)
    if partition_column:
        reader = (reader.option("dbtable", f"({query}) AS q")
                  .option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions or 1)))
    else:
        reader = reader.option("query", query)
    if user is not None:
        reader = reader.option("user", user)
    if password is not None:
        reader = reader.option("password", password)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load()
