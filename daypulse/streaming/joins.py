"""Datapoints with the first day of their user, as a join of two streams.

The datapoint stream keeps every row (left outer); the first-seen stream brings
one row a user. Both carry watermarks, and a match lies at most ``horizon``
before the datapoint, so both sides' states end: a datapoint waits until the
first-seen stream cannot bring a match any more, then leaves once, with a null
first day if there was none. After the end the matched rows equal the batch
form ``sessions_with_age``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from daypulse.streaming.ingest import write_batch


def datapoints_with_age(datapoints: DataFrame, firsts: DataFrame, delay: str = "1 day", horizon: str = "400 days") -> DataFrame:
    """``datapoints``: event_time, date, combined_id, session_length,
    session_count. ``firsts``: first_time, combined_id; one row a user. Ids
    that are null match nothing."""
    left = datapoints.withWatermark("event_time", delay)
    right = firsts.select(F.col("combined_id").alias("_first_id"), "first_time").withWatermark("first_time", delay)
    near = F.expr(f"first_time <= event_time AND first_time >= event_time - INTERVAL {horizon}")
    joined = left.join(right, (F.col("combined_id") == F.col("_first_id")) & near, "left_outer")
    return joined.select("date", "combined_id", F.to_date("first_time").alias("earliest_date"), "session_length",
                         "session_count", "event_time")


def first_seen(datapoints: DataFrame, delay: str) -> DataFrame:
    """The first-seen stream of a datapoint stream in which users first appear
    in order: the first row of each id within ``delay``, later ones with it."""
    rows = datapoints.select("combined_id", F.col("event_time").alias("first_time"))
    return rows.withWatermark("first_time", delay).dropDuplicatesWithinWatermark(["combined_id"])


def start_age_job(datapoints: DataFrame, firsts: DataFrame, target: str, checkpoint: str, delay: str = "1 day",
                  horizon: str = "400 days", trigger: dict | None = None) -> StreamingQuery:
    """Land the joined datapoints by day."""
    rows = datapoints_with_age(datapoints, firsts, delay, horizon)
    return (rows.writeStream
            .queryName("datapoints_with_age")
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .foreachBatch(lambda batch, n: write_batch(batch, n, target))
            .trigger(**(trigger or {"processingTime": "3600 seconds"})).start())
