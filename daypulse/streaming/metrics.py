"""Daily numbers of the session stream, written after each batch.

The session log (:mod:`daypulse.streaming.sessions`) merges by minima and maxima,
so what a batch changes is known from the batch: the sessions it touches, and
with them the users whose datapoints may have changed. A refresh recomputes the
daily tables from the merged log and replaces the days whose numbers changed;
it may be repeated at any time.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from daypulse.operators import bi, sessions
from daypulse.sinks.tables import path_exists, read_table, write_table
from daypulse.streaming.ingest import write_batch
from daypulse.streaming.sessions import STATE_COLS, session_states, sessions_snapshot


@dataclass
class MetricTables:
    new_users: str     # A18, B4
    active: str        # A19: datapoints of the day, of 8 and of 31 days
    returning: str     # A20: D1, D7, D30
    per_day: str       # B5-B8: session time, sessions, users


def daily_metrics(snapshot: DataFrame) -> dict[str, DataFrame]:
    """The daily tables of a sessions table (``schemas.SESSIONS``)."""
    per_day = bi.session_time_avg(snapshot)
    for more in (bi.sessions_avg(snapshot), bi.sessions_total(snapshot), bi.users_per_day(snapshot)):
        per_day = per_day.join(more, "date", "full")  # one row a day on both sides
    return {"new_users": sessions.new_users(snapshot), "active": sessions.active_datapoints(snapshot),
            "returning": sessions.returning_counts(snapshot), "per_day": per_day}


def refresh(spark: SparkSession, log: str, out: MetricTables) -> dict[str, int]:
    """Bring the daily tables up to the log. Returns the number of days that
    were replaced in each."""
    snapshot = sessions_snapshot(spark, log).persist()  # one aggregation of the log for all tables
    replaced = {}
    try:
        for name, rows in daily_metrics(snapshot).items():
            target = getattr(out, name)
            fresh = rows
            if path_exists(spark, target):
                gone = read_table(spark, target).join(rows, "date", "left_anti")
                if not gone.isEmpty():  # late data moved a day's last session: one row a day is written anew
                    replaced[name] = gone.count()
                    write_table(rows, target, partition_by="date", mode="replace")
                    continue
                held = read_table(spark, target).select(*[F.col(c).alias(f"_{c}") for c in rows.columns])
                equal = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in rows.columns]
                fresh = rows.join(held, reduce(lambda a, b: a & b, equal), "left_anti")
            fresh = fresh.persist()
            replaced[name] = fresh.count()  # one row a day
            if replaced[name]:
                write_table(fresh, target, partition_by="date", mode="overwrite")
            fresh.unpersist()
    finally:
        snapshot.unpersist()
    return replaced


def start_metrics_job(client_rows: DataFrame, log: str, out: MetricTables, checkpoint: str,
                      trigger: dict | None = None) -> StreamingQuery:
    """The session stream of :func:`daypulse.streaming.sessions.start_session_job`
    that also refreshes the daily tables behind each batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(session_states(batch).select(*STATE_COLS), batch_id, log, partition_by=())
        refresh(batch.sparkSession, log, out)

    return (client_rows.writeStream
            .queryName("session_metrics")
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .foreachBatch(write)
            .trigger(**(trigger or {"processingTime": "3600 seconds"})).start())
