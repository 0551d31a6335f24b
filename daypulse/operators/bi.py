"""Dashboard queries (B1-B12) over the sessions and basics tables.

The workbooks compute these with table calculations; here each is one
grouped aggregate per day (or the interval helpers of ``activity``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypulse.functions.dates import day_trunc
from daypulse.operators.activity import dense_calendar, trailing_active
from daypulse.operators.retention import dx_retention  # noqa: F401  (B3)
from daypulse.operators.sessions import new_users  # noqa: F401  (B4)

# Measures shown on the basics sheet, in sheet order.
BASICS_MEASURES = ("dau", "wau", "mau", "sessions")


def xau(sessions: DataFrame, x: int = 30) -> DataFrame:
    """Users active in the trailing ``x`` days (1 <= x <= 30),
    each day from the first to the last day of data."""
    if not 1 <= x <= 30:
        raise ValueError("x must be in 1..30")
    return trailing_active(sessions, "combined_id", x)


def _exact_avg(col, scale: float = 1.0):
    # The integer sum is exact, so the average is one rounding away from
    # the true value whatever the summation order (unlike avg of doubles).
    return F.sum(F.col(col).cast("bigint")).cast("double") / F.count(F.lit(1)) / F.lit(scale)


def session_time_avg(sessions: DataFrame) -> DataFrame:
    """Average session seconds per day (``INT(sessionLength)/1000``)."""
    return sessions.groupBy("date").agg(
        _exact_avg("session_length", 1000.0).alias("avg_session_seconds"))


def sessions_avg(sessions: DataFrame) -> DataFrame:
    """Average sessions per user-day."""
    return sessions.groupBy("date").agg(_exact_avg("session_count").alias("avg_sessions"))


def sessions_total(sessions: DataFrame) -> DataFrame:
    """Total sessions per day."""
    return sessions.groupBy("date").agg(
        F.sum(F.col("session_count").cast("bigint")).alias("total_sessions"))


def users_per_day(sessions: DataFrame) -> DataFrame:
    """Distinct ids and number of records per day."""
    return sessions.groupBy("date").agg(
        F.count_distinct("combined_id").alias("users"),
        F.count(F.lit(1)).alias("records"))


def basics_per_day(basics: DataFrame) -> DataFrame:
    """Sums of the basics measures over all dimensions, per day."""
    return basics.groupBy("date").agg(*[F.sum(m).alias(m) for m in ("sessions", "dau", "wau", "mau")])


def measures_long(per_day: DataFrame, measures=BASICS_MEASURES) -> DataFrame:
    """B10 (+F13): wide -> long ``(date, measure, value)`` with the sheet's
    fixed measure order as ``measure_order``."""
    order = F.create_map(*[x for i, m in enumerate(measures) for x in (F.lit(m), F.lit(i))])
    long = per_day.select(day_trunc("date").alias("date"), *measures).unpivot(
        ["date"], list(measures), "measure", "value")
    return long.select("date", "measure", F.col("value").cast("bigint").alias("value"),
                       F.element_at(order, F.col("measure")).alias("measure_order"))


def date_range(rows: DataFrame, start: str, end: str, date_col: str = "date") -> DataFrame:
    """Inclusive day range."""
    return rows.filter(F.col(date_col).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def full_range(per_day: DataFrame, value_cols, date_col: str = "date") -> DataFrame:
    """B12: "show full range" — missing days appear with 0."""
    return dense_calendar(per_day, value_cols, date_col)
