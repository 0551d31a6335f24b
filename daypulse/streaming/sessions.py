"""Session stream (T3-T6): an append-only log of mergeable session states.

Every micro-batch is reduced to one state per session id that it touches and
written to the log under its own ``(_run_id, _batch_id)`` partition; a replayed
batch rewrites exactly that partition, a new checkpoint (a new run id) adds its
own, and no batch reads or rewrites what an earlier one stored. A visitor who
returns after a year costs one row.

States of one session merge by minima and maxima (:func:`merge_states`), so the
order, the number and even repeats of versions do not matter. Hence:

* ``state="log"`` (default) aggregates each batch by itself: the stream holds
  no state, the log is the state.
* ``state="store"`` keeps the running state in the state store (RocksDB on a
  cluster), and each logged row is the session's full state so far. The store
  has no timeout and grows with the number of session ids.
* ``state="expiring"`` keeps the running state of a session and a window of event
  time (``window``, a day), and forgets it once the watermark (the largest event
  time, less ``delay``) has passed the window's end. The state is bounded by the
  sessions of ``window`` + ``delay``, and each logged row is what one window holds
  of a session, so a session over several windows, or one that comes back after
  its state has ended, is merged in the log like any other. Rows older than the
  watermark are not counted; the query's progress tells how many.

The tables the BI reads are derived from the merged log: sessions
(:func:`current_sessions`) and the five-column datapoints with the first-seen
day (:func:`sessions_snapshot`, T4, T5, J5, A17), equal to the batch
definition ``sessions_table`` of all rows read so far, also when late data moves
a session to another day or names an anonymous visitor. :func:`compact` folds
the log into one row per session.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from daypulse.operators.identity import combined_identity
from daypulse.operators.sessions import REQUIRED, gap_windows, session_datapoints, sessions_with_age
from daypulse.sinks.tables import read_table, write_table
from daypulse.streaming.ingest import write_batch

STATE_COLS = ("_id", "known", "date", "start_t", "end_t")


def session_states(client_rows: DataFrame) -> DataFrame:
    """T3 on a stream or batch: one state per session id. ``known`` is the
    first non-empty uid with its time, null for an anonymous session."""
    rows = client_rows.na.drop(subset=list(REQUIRED)).select(
        "_id", F.when(F.col("uid") != "", F.struct("t", "uid")).alias("known"), "date",
        F.col("t").alias("start_t"), F.col("t").alias("end_t"))
    return merge_states(rows)


def expiring_states(client_rows: DataFrame, window: str, delay: str) -> DataFrame:
    """T3 with an end: the states of a stream by session and window of event
    time, forgotten behind the watermark."""
    rows = client_rows.na.drop(subset=list(REQUIRED)).withColumn("_at", F.timestamp_millis("t")).withWatermark("_at", delay)
    states = rows.select("_id", F.when(F.col("uid") != "", F.struct("t", "uid")).alias("known"), "date",
                         F.col("t").alias("start_t"), F.col("t").alias("end_t"), "_at")
    return merge_states(states, F.window("_at", window))


def merge_states(states: DataFrame, *by) -> DataFrame:
    """One state per session id of any number of states (or rows) of it."""
    return states.groupBy("_id", *by).agg(F.min("known").alias("known"), F.min("date").alias("date"),
                                     F.min("start_t").alias("start_t"), F.max("end_t").alias("end_t"))


def _merged(spark: SparkSession, logs: tuple[str, ...]) -> DataFrame:
    rows = [read_table(spark, log).select(*STATE_COLS) for log in logs]
    return merge_states(reduce(DataFrame.unionByName, rows))


def current_sessions(spark: SparkSession, *logs: str) -> DataFrame:
    """The sessions of one or more logs, as ``session_rollup`` gives them. A
    log and its compacted copy may both be named."""
    return _merged(spark, logs).select("_id", F.coalesce(F.col("known.uid"), F.lit("")).alias("uid"), "date", "start_t",
                                     "end_t")


def sessions_snapshot(spark: SparkSession, *logs: str) -> DataFrame:
    """T4 + T5 + A17 of the stream: the sessions table (``schemas.SESSIONS``)."""
    return sessions_with_age(session_datapoints(current_sessions(spark, *logs)))


def compact(spark: SparkSession, target: str, *logs: str) -> None:
    """Fold logs into a new log of one row per session. A failed run may be
    repeated; the logs stay as they are (merging one twice changes nothing), so
    their covered partitions can be dropped at any later time."""
    if target in logs:
        raise ValueError("compact into a new log, not into one that is read")
    write_table(_merged(spark, logs), target, mode="overwrite")


def start_session_job(client_rows: DataFrame, log: str, checkpoint: str, trigger: dict | None = None,
                      state: str = "log", window: str = "1 day", delay: str = "1 day") -> StreamingQuery:
    """Start the session stream into ``log`` (a path or catalog table).
    ``client_rows`` is a landed client stream
    (see :func:`daypulse.streaming.ingest.client_rows`)."""
    if state not in ("log", "store", "expiring"):
        raise ValueError("state: 'log', 'store' or 'expiring'")
    rows = {"log": lambda: client_rows, "store": lambda: session_states(client_rows),
            "expiring": lambda: expiring_states(client_rows, window, delay)}[state]()

    def write(batch: DataFrame, batch_id: int) -> None:
        found = session_states(batch) if state == "log" else batch
        write_batch(found.select(*STATE_COLS), batch_id, log, partition_by=())

    return (rows.writeStream
            .queryName("sessions")
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .foreachBatch(write)
            .trigger(**(trigger or {"processingTime": "3600 seconds"})).start())


def start_gap_sessions(rows: DataFrame, target: str, checkpoint: str, gap: str = "30 minutes", delay: str = "1 hour",
                       time_col: str = "ts", trigger: dict | None = None) -> StreamingQuery:
    """Sessions by silence (``sessions_by_gap``) from a stream. A session
    is landed once, when the watermark has passed its end plus ``gap``; rows up
    to ``delay`` late still join or bridge sessions."""
    timed = rows.select(combined_identity().alias("combined_id"), F.col(time_col).cast("timestamp").alias("_at")).where(
        "_at IS NOT NULL AND combined_id IS NOT NULL").withWatermark("_at", delay)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch.withColumn("date", F.to_date(F.timestamp_millis("start_t"))), batch_id, target)

    return (gap_windows(timed, gap).writeStream
            .queryName("gap_sessions")
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .foreachBatch(write)
            .trigger(**(trigger or {"processingTime": "3600 seconds"})).start())
