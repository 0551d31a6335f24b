"""Keep-one dedup across micro-batches (A16 as a stream, with T8's watermark).

A row whose key was seen less than ``delay`` of event time ago is dropped, in
whatever micro-batch it arrives. The state holds one entry a key and forgets it
once the watermark (the largest event time seen, less ``delay``) has passed it,
so it is bounded by the keys of one delay, not by all keys ever seen; it lives
in the checkpoint, so a restart forgets nothing.

Bounds of the promise: a repeat within ``delay`` of the first row is always
dropped; one that comes later may be landed again, and :func:`repeats` counts
those; a row that is itself older than the watermark is not landed, and
:func:`dropped` counts those from the query's progress. Of several rows of a key
inside one micro-batch any one stays. On data that arrives in order, with its
repeats within the delay, the result is that of the batch operators
``dedup_payments`` and ``dedup_refunds``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from daypulse.streaming.ingest import BATCH_COL, RUN_COL, write_batch


def keep_first(rows: DataFrame, keys: Iterable[str], time_col: str, delay: str) -> DataFrame:
    """The stream without the repeats of a key within ``delay``. Rows without
    an event time have no place in it and are left out."""
    timed = rows.where(F.col(time_col).isNotNull()).withWatermark(time_col, delay)
    return timed.dropDuplicatesWithinWatermark(list(keys))


def start_dedup_job(rows: DataFrame, target: str, checkpoint: str, keys: Iterable[str], time_col: str, delay: str,
                    partition_by: tuple[str, ...] = ("date",), trigger: dict | None = None) -> StreamingQuery:
    """Land the first row of each key; a replayed batch rewrites its own
    partitions only (as stage 1 does)."""
    return (keep_first(rows, keys, time_col, delay).writeStream
            .queryName("dedup")
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .foreachBatch(lambda batch, n: write_batch(batch, n, target, partition_by=partition_by))
            .trigger(**(trigger or {"processingTime": "3600 seconds"})).start())


def repeats(landed: DataFrame, keys: Iterable[str], time_col: str) -> DataFrame:
    """Keys that were landed more than once, since their rows lie farther
    apart than the delay: the key, copies, and the first and last time."""
    return (landed.drop(RUN_COL, BATCH_COL).groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("copies"), F.min(time_col).alias("first_time"), F.max(time_col).alias("last_time"))
            .where("copies > 1"))


def dropped(query: StreamingQuery) -> dict[str, int]:
    """Rows that the recent batches of a query did not land: ``repeats``
    within the delay, and ``late`` ones behind the watermark."""
    states = [s for p in query.recentProgress for s in p.stateOperators]
    return {"repeats": sum(int(s.customMetrics.get("numDroppedDuplicateRows", 0)) for s in states),
            "late": sum(s.numRowsDroppedByWatermark for s in states)}
