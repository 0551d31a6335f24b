"""Stage 1: land client and server log streams.

Two streaming queries run side by side. Each micro-batch is parsed with an
explicit schema (no inference pass), persisted once, and fanned out to its
tables inside **one** ``foreachBatch``; every write is partitioned by
``date``, ``_run_id`` and ``_batch_id`` with dynamic partition overwrite, so a
batch replayed after a failure rewrites exactly the partitions it wrote before
(idempotent), and empty batches write nothing. Batch ids restart with every
new checkpoint; the run id is the query id kept in the checkpoint, so a new
checkpoint adds to what an earlier one landed.

With a ``manifest`` a batch is listed once all its targets are written, and
readers that take listed batches only (:mod:`daypulse.sinks.commits`) see all
targets of a batch or none, also while it is being written or replayed.

Rows that cannot be landed (not JSON, no or no plausible time, no action) go
to the quarantine table with the line and a reason, if one is named.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.streaming import StreamingQuery

from daypulse import schemas
from daypulse.functions.labels import ROUTES
from daypulse.operators import logs
from daypulse.operators.extra_fields import EXTRA, extra
from daypulse.sinks.commits import BATCH_COL, RUN_COL, commit_batch
from daypulse.sinks.tables import write_table


def client_rows(lines: DataFrame, tz: str = "UTC", keep_extra: bool = False) -> DataFrame:
    """S3 + P1 + P2 on a stream (or batch) of client JSON lines. With
    ``keep_extra`` a row with fields outside the schema carries its object in
    ``_extra`` (:mod:`daypulse.operators.extra_fields`)."""
    if keep_extra:
        lines = lines.withColumn(EXTRA, extra("value", schemas.CLIENT_LOG.names))
    parsed = logs.parse_json(lines, "value", schemas.CLIENT_LOG, keep=[EXTRA] if keep_extra else ())
    return logs.land_client_rows(parsed, tz=tz).withColumnRenamed("appId", "app_id")


def server_rows(lines: DataFrame) -> DataFrame:
    """S4 on a stream (or batch) of server log lines."""
    return logs.parse_server_lines(lines, "value")


def current_run(spark) -> str:
    """The running stream's query id (it stays with its checkpoint)."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def write_batch(batch: DataFrame, batch_id: int, target: str, also_table: str | None = None,
                run_id: str | None = None, partition_by=("date",)) -> None:
    """Write one micro-batch, idempotently (dynamic overwrite of its own
    ``(date, _run_id, _batch_id)`` partitions). K9: ``also_table`` writes the
    same rows to a second target (e.g. a catalog table next to the files)."""
    rows = batch.withColumn(RUN_COL, F.lit(run_id or current_run(batch.sparkSession))).withColumn(
        BATCH_COL, F.lit(batch_id))
    if also_table:
        rows = rows.persist()  # parsed once, written twice
    try:
        for t in [target] + ([also_table] if also_table else []):
            write_table(rows, t, partition_by=[*partition_by, RUN_COL, BATCH_COL], mode="overwrite")
    finally:
        if also_table:
            rows.unpersist()


def reset_targets(spark, targets: dict[str, tuple[str, StructType]]) -> None:
    """S2 replay: replace every target by an empty table of its schema (a
    static overwrite of the whole path). Pair it with a new checkpoint
    folder and ``from_start=True`` on the source."""
    from daypulse.sources.tables import empty_table
    for path, schema in targets.values():
        write_table(empty_table(spark, schema), path, mode="overwrite")


# Keys of the keep-one dedup (A16) per route, ``dedup_scope="batch"``.
DEDUP_KEYS = {"payment": ("purchaseNumber",), "refund": ("purchaseNumber", "actionType")}


def keep_one(rows: DataFrame, keys) -> DataFrame:
    """A16 inside one batch: one row per key, the smallest by all other
    columns (deterministic, unlike an arbitrary ``dropDuplicates``)."""
    from daypulse.operators.commerce import first_per_key
    rest = [c for c in rows.columns if c not in keys]
    return first_per_key(rows, list(keys), rest, rest)


def fan_out(batch: DataFrame, batch_id: int, targets: dict[str, str],
            action_col: str = "actionType", dedup_scope: str | None = None,
            run_id: str | None = None) -> None:
    """K7: one parsed batch -> one table per route (rows of no route are
    dropped, as the reference's filters drop them). ``dedup_scope="batch"``
    keeps one payment per purchase and one refund per (purchase, action)
    within the batch (A16); table-wide dedup is the batch operator
    :func:`daypulse.operators.commerce.dedup_payments` / ``dedup_refunds``."""
    batch = batch.persist()
    try:
        for name, target in targets.items():
            routed = batch.filter(F.col(action_col).isin(*ROUTES[name]))
            if dedup_scope == "batch" and name in DEDUP_KEYS:
                routed = keep_one(routed, DEDUP_KEYS[name])
            write_batch(routed, batch_id, target, run_id=run_id)
    finally:
        batch.unpersist()


@dataclass
class IngestTargets:
    client: str
    payment: str
    refund: str
    student: str
    signup: str
    quarantine: str | None = None
    client_table: str | None = None  # K9: the client rows once more, as a catalog table
    keep_extra: bool = False  # S3: client fields outside the schema are kept in _extra
    manifest: str | None = None  # list of the batches whose targets are all written (sinks.commits)

    def server_routes(self) -> dict[str, str]:
        return {"payment": self.payment, "refund": self.refund,
                "student": self.student, "signup": self.signup}


def _quarantine(rejected: DataFrame, stream: str, batch_id: int, target: str) -> None:
    write_batch(rejected.select("value", "reason", F.lit(stream).alias("stream")), batch_id, target, partition_by=("stream",))


def _listed(lines: DataFrame, stream: str, batch_id: int, targets: IngestTargets) -> None:
    """The last write of a batch: from now on readers of listed batches see it."""
    if targets.manifest:
        commit_batch(lines.sparkSession, targets.manifest, stream, current_run(lines.sparkSession), batch_id)


def land_client(lines: DataFrame, batch_id: int, targets: IngestTargets, tz: str = "UTC") -> None:
    """One micro-batch of client lines: landed, and the rest quarantined."""
    lines = lines.persist()
    try:
        write_batch(client_rows(lines, tz, targets.keep_extra), batch_id, targets.client, targets.client_table)
        if targets.quarantine:
            parsed = logs.parse_json(lines, "value", schemas.CLIENT_LOG, keep=["value"])
            _quarantine(logs.rejected_client_rows(parsed), "client", batch_id, targets.quarantine)
        _listed(lines, "client", batch_id, targets)
    finally:
        lines.unpersist()


def land_server(lines: DataFrame, batch_id: int, targets: IngestTargets) -> None:
    """One micro-batch of server lines: routed, and the rest quarantined."""
    lines = lines.persist()
    try:
        fan_out(server_rows(lines), batch_id, targets.server_routes())
        if targets.quarantine:
            _quarantine(logs.rejected_server_lines(lines), "server", batch_id, targets.quarantine)
        _listed(lines, "server", batch_id, targets)
    finally:
        lines.unpersist()


def start_ingest(client_lines: DataFrame, server_lines: DataFrame, targets: IngestTargets,
                 checkpoint_root: str, trigger: dict | None = None,
                 tz: str = "UTC") -> tuple[StreamingQuery, StreamingQuery]:
    """Start both landing queries (T7). ``trigger`` defaults to hourly
    (``{"processingTime": "3600 seconds"}``); tests use
    ``{"availableNow": True}``. Each query has its own checkpoint (T2), so a
    restart resumes from the last committed offsets."""
    trig = trigger or {"processingTime": "3600 seconds"}
    client_q = (client_lines.writeStream
                .queryName("land_client")
                .option("checkpointLocation", f"{checkpoint_root.rstrip('/')}/client")
                .foreachBatch(lambda df, bid: land_client(df, bid, targets, tz))
                .trigger(**trig).start())
    server_q = (server_lines.writeStream
                .queryName("land_server")
                .option("checkpointLocation", f"{checkpoint_root.rstrip('/')}/server")
                .foreachBatch(lambda df, bid: land_server(df, bid, targets))
                .trigger(**trig).start())
    return client_q, server_q
