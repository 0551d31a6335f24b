"""Sessions and daily datapoints (batch forms of T3-T5) and the tables
derived from them (A17-A20).

The streaming job (``daypulse.streaming.sessions``) keeps the session state
with the same aggregate expressions; these functions are the batch
definition it must agree with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daypulse.operators.identity import combined_identity

REQUIRED = ("t", "uid", "_id")


def session_aggs() -> list[Column]:
    """T3 state merge as aggregates: first non-empty uid (earliest by event
    time, then by value), first day, first and last event time."""
    known = F.when(F.col("uid") != "", F.struct("t", "uid"))
    return [F.coalesce(F.min(known)["uid"], F.lit("")).alias("uid"),
            F.min("date").alias("date"),
            F.min("t").alias("start_t"),
            F.max("t").alias("end_t")]


def session_rollup(client_rows: DataFrame) -> DataFrame:
    """One row per session id over all rows seen."""
    rows = client_rows.na.drop(subset=list(REQUIRED))
    return rows.groupBy("_id").agg(*session_aggs())


def session_datapoints(sessions: DataFrame) -> DataFrame:
    """T4 (corrected): per (combined id, first day of the session), the sum
    of session lengths and the number of sessions. Derived from the latest
    session rows, so a session touched in two batches counts once."""
    return (sessions.groupBy(combined_identity().alias("combined_id"), "date")
            .agg(F.sum(F.col("end_t") - F.col("start_t")).alias("session_length"),
                 F.count(F.lit(1)).alias("session_count")))


def sessions_with_age(datapoints: DataFrame) -> DataFrame:
    """T5 + J5: each datapoint with the first day of its combined id.

    The window partition of one id holds one row per day."""
    first = F.min("date").over(Window.partitionBy("combined_id"))
    return datapoints.select("date", "combined_id", first.alias("earliest_date"),
                             "session_length", "session_count")


def sessions_table(client_rows: DataFrame) -> DataFrame:
    """Client rows -> the sessions table the BI reads (T3 -> T4 -> T5)."""
    return sessions_with_age(session_datapoints(session_rollup(client_rows)))


def sessions_by_gap(rows: DataFrame, gap: str = "30 minutes", time_col: str = "ts", key=None) -> DataFrame:
    """Sessions of a user by silence: an event belongs to the session of
    the one before it if it comes at most ``gap`` later. One row a session:
    combined_id, start_t, end_t (first and last event, epoch ms), events and
    session_length (ms). Rows without a time, or without an id, are left out.

    The same code runs on a stream with a watermark (see
    :mod:`daypulse.streaming.sessions`): ``session_window`` merges the
    windows of a key by sorting them within their partition, after the
    partial merge on the map side.
    """
    key = combined_identity() if key is None else key
    timed = rows.select(key.alias("combined_id"), F.col(time_col).cast("timestamp").alias("_at")).where(
        "_at IS NOT NULL AND combined_id IS NOT NULL")
    return gap_windows(timed, gap)


def gap_windows(timed: DataFrame, gap: str) -> DataFrame:
    """The aggregation of :func:`sessions_by_gap` on (combined_id, _at)."""
    found = timed.groupBy("combined_id", F.session_window("_at", gap).alias("_w")).agg(
        F.unix_millis(F.min("_at")).alias("start_t"), F.unix_millis(F.max("_at")).alias("end_t"),
        F.count(F.lit(1)).alias("events"))
    return found.select("combined_id", "start_t", "end_t", "events", (F.col("end_t") - F.col("start_t")).alias("session_length"))


def snapshot(change_log: DataFrame) -> DataFrame:
    """Current state from an appended log of datapoint states."""
    return change_log.groupBy("date", "combined_id").agg(
        F.min("earliest_date").alias("earliest_date"),
        F.max("session_length").alias("session_length"),
        F.max("session_count").alias("session_count"))


def new_users(sessions: DataFrame) -> DataFrame:
    """Datapoints whose day is the id's first day, per day."""
    return sessions.groupBy("date").agg(
        F.count_if(F.col("date") == F.col("earliest_date")).alias("new_users"))


def active_datapoints(sessions: DataFrame, wau_days: int = 8, mau_days: int = 31) -> DataFrame:
    """Datapoint rows of the day, of the trailing 8 and 31 days
    (row counts, not distinct users, as the streaming job reports).

    Counts are additive, so they are taken per day first; only the
    per-day table (one row per day) is shifted 0..30 days.
    """
    daily = sessions.groupBy("date").agg(F.count(F.lit(1)).alias("_n"))
    off = F.col("_off")
    shifted = daily.select(F.explode(F.sequence(F.lit(0), F.lit(mau_days - 1))).alias("_off"),
                           "date", "_n")
    return (shifted.groupBy(F.date_add("date", off).alias("date")).agg(
        F.coalesce(F.sum(F.when(off == 0, F.col("_n"))), F.lit(0)).cast("bigint").alias("dau"),
        F.coalesce(F.sum(F.when(off < wau_days, F.col("_n"))), F.lit(0)).cast("bigint").alias("wau"),
        F.sum("_n").cast("bigint").alias("mau")))


def returning_counts(sessions: DataFrame, days=(1, 7, 30)) -> DataFrame:
    """Datapoints of age N per day, all N in one pass."""
    age = F.datediff("date", "earliest_date")
    return sessions.groupBy("date").agg(
        *[F.count_if(age == n).alias(f"d{n}_returning") for n in days])
