"""Log landing: JSON parse, server-line parse, required fields, routing
(S3, S4, P1-P4, P13, P14, A15).

All functions work on batch and streaming DataFrames alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daypulse import schemas
from daypulse.functions import labels
from daypulse.functions.dates import millis_to_date, plausible_millis

# Server line layout. The first 10 characters are the day,
# the JSON body starts at character 25 (1-based); shorter lines are noise.
SERVER_LINE_MIN_LENGTH = 25
SERVER_DATE_CHARS = 10
SERVER_BODY_START = 25

VIDEO_CATEGORY = "userBehavior"
VIDEO_ACTION = "lessonPlaybackTriggered"


def parse_json(df: DataFrame, value_col: str, schema: T.StructType,
               corrupt_col: str = schemas.CORRUPT, keep=()) -> DataFrame:
    """S3: one JSON object per row -> typed columns, explicit schema.

    Malformed rows are kept: all fields null and the text in ``corrupt_col``.
    """
    full = schemas.with_corrupt(schema, corrupt_col)
    parsed = F.from_json(F.col(value_col), full,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt_col})
    return df.select(*keep, parsed.alias("_j")).select(*keep, "_j.*")


def parse_server_lines(lines: DataFrame, line_col: str = "line",
                       schema: T.StructType = schemas.SERVER_LOG, keep=()) -> DataFrame:
    """``<date><time text> {json}`` -> typed columns plus ``date``.

    The body is parsed as is and the day added as a column (instead of
    splicing a ``"date"`` key into the JSON text).
    """
    line = F.col(line_col)
    kept = lines.filter(F.length(line) >= SERVER_LINE_MIN_LENGTH)
    body = F.substr(line, F.lit(SERVER_BODY_START))
    with_body = kept.select(
        *keep,
        F.try_to_date(F.substr(line, F.lit(1), F.lit(SERVER_DATE_CHARS))).alias("date"),
        body.alias("_body"))
    return parse_json(with_body, "_body", schema, keep=[*keep, "date"])


def land_client_rows(raw: DataFrame, required=("t",), tz: str = "UTC") -> DataFrame:
    """P1 + P2: drop rows missing a required field, add the calendar day. A
    ``t`` outside the range of real days is missing too: one such row must not
    end a stream or make a partition of its own (see :func:`rejected_client_rows`)."""
    return (raw.na.drop(subset=list(required)).where(plausible_millis("t"))
            .withColumn("date", millis_to_date("t", tz)))


def rejected_client_rows(raw: DataFrame, required=("t",)) -> DataFrame:
    """The rows that :func:`land_client_rows` drops, with the ``reason``."""
    missing = F.lit(False)
    for c in required:
        missing = missing | F.col(c).isNull()
    reason = F.when(missing, "missing field").otherwise("bad time")
    if schemas.CORRUPT in raw.columns:
        reason = F.when(F.col(schemas.CORRUPT).isNotNull(), "not json").otherwise(reason)
    return raw.where(missing | ~plausible_millis("t")).withColumn("reason", reason)


def rejected_server_lines(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Lines too short to hold a body, or whose body names no action, with
    the ``reason``."""
    short = lines.filter(F.coalesce(F.length(line_col), F.lit(0)) < SERVER_LINE_MIN_LENGTH).select(
        line_col, F.lit("short line").alias("reason"))
    parsed = parse_server_lines(lines, line_col, keep=[line_col])
    return short.unionByName(parsed.filter(F.col("actionType").isNull()).select(line_col, F.lit("no action").alias("reason")))


def with_route(server_rows: DataFrame, action_col: str = "actionType") -> DataFrame:
    """Add the target table of each row (null: no table)."""
    return server_rows.withColumn("route", labels.route_of(action_col))


def route(server_rows: DataFrame, name: str, action_col: str = "actionType") -> DataFrame:
    """The rows of one target table, as a pushable ``isin`` filter."""
    return server_rows.filter(F.col(action_col).isin(*labels.ROUTES[name]))


def video_playback_filter(client_rows: DataFrame) -> DataFrame:
    """Lesson playback events; null-safe (null never matches)."""
    return client_rows.filter((F.col("e_c") == VIDEO_CATEGORY) & (F.col("e_a") == VIDEO_ACTION))


def video_playbacks(client_rows: DataFrame) -> DataFrame:
    """Playback events per day."""
    return (video_playback_filter(client_rows)
            .groupBy("date").agg(F.count(F.lit(1)).alias("cnt")))


def day_of(ms, tz: str = "UTC"):
    """The day of an epoch-millisecond field; null when null or no real time."""
    return F.when(plausible_millis(ms), millis_to_date(ms, tz))


def landed_payments(server_rows: DataFrame, tz: str = "UTC") -> DataFrame:
    """Landed payment rows in the layout of A7, A12 and A16."""
    return route(server_rows, "payment").select(
        F.col("purchaseNumber").alias("purchase_number"), F.col("totalPrice").alias("total_price"),
        F.col("payChannel").alias("pay_channel"), F.col("payTime").alias("pay_time"),
        day_of("payTime", tz).alias("pay_date"), "date")


def landed_refunds(server_rows: DataFrame) -> DataFrame:
    """Landed refund rows in the layout of A11 and A16."""
    return route(server_rows, "refund").select(
        F.col("purchaseId").alias("purchase_id"), F.col("actionType").alias("action_type"), "money",
        F.col("purchaseMoney").alias("purchase_money"), "status", "date")


def landed_signups(server_rows: DataFrame) -> DataFrame:
    """Landed signup rows in the layout of A13."""
    return route(server_rows, "signup").select(
        F.col("purchaseId").alias("purchase_id"), F.col("purchaseClassNames").alias("class_names"), "date")


def landed_students(server_rows: DataFrame) -> DataFrame:
    """Landed student rows in the layout of A14."""
    return route(server_rows, "student").select(F.col("studentId").alias("student_id"), "date")


def server_payment_records(server_rows: DataFrame, tz: str = "UTC") -> DataFrame:
    """P11 + P13 on raw server rows: the payment table layout; the day is
    the pay time's day, else the log day."""
    paid = day_of("payTime", tz)
    return (route(server_rows, "payment")
            .select("actionType", F.col("studentId").alias("userId"), "purchaseNumber",
                    paid.alias("payTime"), "payChannel", "totalPrice",
                    F.coalesce(paid, F.col("date")).alias("date")))


def server_refund_records(server_rows: DataFrame, tz: str = "UTC") -> DataFrame:
    """P9 + P11 + P13 on raw server rows: the refund table layout with the
    status name of the status code and the business day = verify time,
    else update time, else the log day (verify time kept as a day, null if
    absent)."""
    verify = day_of("verifyTime", tz)
    update = day_of("updateTime", tz)
    return (route(server_rows, "refund")
            .select("actionType", F.col("studentId").alias("userId"),
                    verify.alias("verifyTime"), "classId", "purchaseNumber",
                    "purchaseMoney", F.col("money").alias("refundMoney"), "status",
                    labels.refund_status_name("status").alias("statusName"),
                    F.coalesce(verify, update, F.col("date")).alias("date")))


def refund_records(refunds: DataFrame) -> DataFrame:
    """P13 (+P9): refund rows reshaped to the refund table layout."""
    return (route(refunds, "refund", "action_type")
            .select("action_type",
                    F.col("purchase_id").cast("string").alias("purchase_number"),
                    "purchase_money",
                    F.col("money").alias("refund_money"),
                    "status",
                    labels.refund_status_name("status").alias("status_name"),
                    "date"))
