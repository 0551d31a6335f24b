"""Stage-2 batch jobs: landed tables -> product tables.

What the operators look like when run for real: each job reads the landed
``date``-partitioned tables (partition pruning through typed date
predicates), derives its products and writes them with dynamic partition
overwrite, so re-running a day replaces exactly that day.

The client job writes the user-day table first and reads it back: a written
table both cuts the lineage (a lost executor does not re-run the raw-log
aggregation) and is read once per consumer from shared storage.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daypulse import schemas
from daypulse.operators import activity, commerce, funnel, logs, retention
from daypulse.operators.user_day import user_day, user_day_dims
from daypulse.sinks.tables import is_path, path_exists, read_table, write_table
from daypulse.sources.tables import empty_table, scan


@dataclass
class ClientOutputs:
    user_day: str
    basics: str
    retention: str
    report_opens: str
    funnels: str
    video_playbacks: str
    user_urls: str     # per day, user and URL: what opens and funnels are rebuilt from
    first_visits: str  # a log of first days by run; the minimum holds
    mark: str          # A9: the last closed day


def _since(df: DataFrame, since: str | None, look_back_days: int = 0) -> DataFrame:
    if since is None:
        return df
    start = F.date_sub(F.lit(since).cast("date"), look_back_days)
    return df.filter(F.col("date") >= start)


def stored_since(spark: SparkSession, mark: str) -> str | None:
    """The first day that the next run reads: the one behind the stored mark."""
    if not path_exists(spark, mark):
        return None
    row = read_table(spark, mark).select(F.date_add("processed_until", 1).cast("string")).first()
    return row[0] if row else None


def run_client_job(spark: SparkSession, client_path: str, geo_ranges: DataFrame,
                   out: ClientOutputs, since: str | None = None, full: bool = False) -> None:
    """A1 -> (A2, A8/A10), A3-A6, A15 from the landed client table.

    A run reads the raw rows from ``since`` on (default: the day behind the
    mark that the last run stored; ``full`` or a first run: all). Daily tables
    (user-days, URLs of users, basics, retention, playbacks) replace those days
    only; A2 reads 30 more days of stored user-days so that trailing windows are
    complete; first days are a log, one partition per run, whose minimum holds.
    Every write may be repeated, and the mark moves last, so a run that died
    is simply run again.
    """
    since = None if full else since or stored_since(spark, out.mark)
    rows = _since(scan(spark, client_path).withColumnRenamed("appId", "app_id"), since)
    if since and not path_exists(spark, out.user_day):
        raise ValueError("no stored user-days before 'since': make a full run first")
    write_table(user_day(rows), out.user_day, partition_by="date", mode="overwrite")
    days = spark.read.parquet(out.user_day)
    new_days = _since(days, since)
    basics = activity.active_users_interval(user_day_dims(_since(days, since, activity.HORIZON), geo_ranges))
    write_table(_since(basics, since), out.basics, partition_by="date", mode="overwrite")

    seen = activity.first_visit(new_days).withColumn("_since", F.lit(since or "all"))
    write_table(seen, out.first_visits, partition_by="_since", mode="overwrite" if since else "replace")
    first = spark.read.parquet(out.first_visits).groupBy("uid").agg(F.min("earliest_date").alias("earliest_date"))
    write_table(retention.retention_since(new_days, first), out.retention, partition_by="date", mode="overwrite")

    write_table(funnel.user_urls(rows, by=["date"]), out.user_urls, partition_by="date", mode="overwrite")
    urls = spark.read.parquet(out.user_urls)
    write_table(funnel.open_distribution(urls, counted=True), out.report_opens, mode="overwrite")
    write_table(funnel.funnel_paths(funnel.user_steps(urls, counted=True)), out.funnels, mode="overwrite")
    write_table(logs.video_playbacks(rows), out.video_playbacks, partition_by="date", mode="overwrite")
    write_table(activity.high_water_mark(days), out.mark, mode="overwrite")


@dataclass
class ServerOutputs:
    revenue: str
    refunds: str
    signups: str
    students: str
    payment_records: str | None = None  # the P13 layouts, one row per key (A16)
    refund_records: str | None = None


def landed_server_rows(spark: SparkSession, target: str) -> DataFrame:
    """What stage 1 landed in one server table; no rows if it never had any."""
    fields = [*schemas.SERVER_LOG.fields, T.StructField("date", T.DateType())]
    if not path_exists(spark, target):
        return empty_table(spark, T.StructType(fields))
    return landed_server_rows_of(spark.read.schema(T.StructType(fields)).parquet(target) if is_path(target) else spark.table(target))


def landed_server_rows_of(found: DataFrame) -> DataFrame:
    """The columns of a server table, without those of the landing."""
    return found.select(*[f.name for f in schemas.SERVER_LOG.fields], "date")


def run_server_job(spark: SparkSession, landed: dict[str, str], out: ServerOutputs, tz: str = "UTC",
                   on_unknown: str = "label") -> None:
    """A11-A14 (and P13) from the tables that stage 1 landed (``landed``: route
    -> target, as ``IngestTargets.server_routes`` gives them). Each product is
    rebuilt from all landed rows and replaced whole: a later row moves a
    purchase or a student to another day, and the day left must not keep it."""
    payments, refunds, signups, students = (
        landed_server_rows(spark, landed[n]) for n in ("payment", "refund", "signup", "student"))
    products = [
        (commerce.revenue_by_channel(logs.landed_payments(payments, tz), on_unknown=on_unknown), out.revenue),
        (commerce.refund_by_status(logs.landed_refunds(refunds), on_unknown), out.refunds),
        (commerce.signup_by_class(logs.landed_signups(signups)), out.signups),
        (commerce.students_by_day(logs.landed_students(students)), out.students)]
    for rows, keys, target in (
            (logs.server_payment_records(payments, tz), ["purchaseNumber"], out.payment_records),
            (logs.server_refund_records(refunds, tz), ["purchaseNumber", "actionType"], out.refund_records)):
        if target:
            rest = ["date", *[c for c in rows.columns if c not in keys and c != "date"]]
            products.append((commerce.first_per_key(rows, keys, rest, rest), target))
    for rows, target in products:
        write_table(rows, target, partition_by="date", mode="replace")


RELATION_TABLES = ("class_info", "course", "class_grade", "grade", "subject", "class_teacher", "user")


def run_relation_sync(load, target: str) -> None:
    """J6 + S7: load the seven relation tables (``load(name)`` returns a
    DataFrame — e.g. :func:`daypulse.sources.streams.read_jdbc_query` with a
    partitioned range read in production) and run the star join in Spark,
    instead of shipping one big join query to the database; then replace
    the relation table."""
    relation = commerce.class_relation(*[load(n) for n in RELATION_TABLES])
    write_table(relation, target, mode="overwrite")
