"""Retention: day-N retention (A10), its join-chain form (J2-J4), cohort
retention, user age (J2) and the BI's D(X) retention (B3).

Definitions (SURVEY §7, hard point 3):

* ``reference`` (A10): for each day, user-day rows (one per session id) of
  users whose first day was N days earlier, divided by all user-day rows of
  that day (null uid counts in the denominator only). Null when no such
  row; a day with all ratios null is absent.
* ``cohort``: users first seen on day c and active again on c+N, divided by
  the users first seen on c.
* ``same_day_new`` (B3): rows of age X divided by rows of age 0, same day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daypulse.functions.dates import safe_ratio

# The retention days of the result table.
RETENTION_DAYS = (1, 7, 30)


def _rows_per_user_day(user_days: DataFrame) -> DataFrame:
    """Collapse to (date, uid, n): a hot user keeps one row per day."""
    return user_days.groupBy("date", "uid").agg(F.count(F.lit(1)).alias("n"))


def _with_age(per: DataFrame) -> DataFrame:
    # One window partition per user holds at most one row per day.
    first = F.min("date").over(Window.partitionBy("uid"))
    return per.withColumn("age", F.when(F.col("uid").isNotNull(), F.datediff("date", first)))


def retention(user_days: DataFrame, days=RETENTION_DAYS) -> DataFrame:
    """A10, one pass: conditional sums instead of 3 x (join + join)."""
    return _ratios(_with_age(_rows_per_user_day(user_days)), days)


def _ratios(aged: DataFrame, days) -> DataFrame:
    sums = [F.sum(F.when(F.col("age") == n, F.col("n"))).alias(f"r{n}") for n in days]
    per_day = aged.groupBy("date").agg(F.sum("n").alias("current"), *sums)
    cols = [safe_ratio(F.col(f"r{n}"), F.col("current")).alias(f"d{n}_retention") for n in days]
    out = per_day.select("date", *cols)
    return out.filter(F.greatest(*[F.col(f"d{n}_retention").isNotNull() for n in days]))


def retention_since(user_days: DataFrame, first: DataFrame, days=RETENTION_DAYS) -> DataFrame:
    """A10 of the days in ``user_days`` alone, by a table of first days
    (``uid``, ``earliest_date``) over all history."""
    per = _rows_per_user_day(user_days)
    aged = per.join(first.select("uid", "earliest_date"), "uid", "left").withColumn(
        "age", F.datediff("date", "earliest_date"))
    return _ratios(aged, days)


def user_age(user_days: DataFrame) -> DataFrame:
    """User-day rows joined with the user's first day (inner: null uid
    rows drop out), with ``age`` in days."""
    first = (user_days.filter(F.col("uid").isNotNull())
             .groupBy("uid").agg(F.min("date").alias("earliest_date")))
    return (user_days.join(first, "uid")
            .select("date", "uid", "_id", "earliest_date",
                    F.datediff("date", "earliest_date").alias("age")))


def retention_join_chain(user_days: DataFrame, days=RETENTION_DAYS) -> DataFrame:
    """J3 + J4: the reference's formulation — per N an inner join of the
    returning count with the day's row count, then full outer joins on
    ``date``. Kept as its own query; :func:`retention` must equal it."""
    users = user_days.select("date", "uid")
    current = users.groupBy("date").agg(F.count(F.lit(1)).alias("current"))
    aged = user_age(user_days)
    out = None
    for n in days:
        returning = (aged.filter(F.col("age") == n).groupBy("date")
                     .agg(F.count(F.lit(1)).alias("returning")))
        ratio = (current.join(returning, "date")
                 .select("date", (F.col("returning") / F.col("current")).alias(f"d{n}_retention")))
        out = ratio if out is None else out.join(ratio, "date", "full")
    return out


def cohort_retention(user_days: DataFrame, days=RETENTION_DAYS) -> DataFrame:
    """Cohort retention: share of the users first seen on ``date`` who are
    active again exactly N days later; null where day N lies behind the last
    day of the data (it cannot be observed yet)."""
    active = user_days.filter(F.col("uid").isNotNull()).select("uid", "date").distinct()
    first = F.min("date").over(Window.partitionBy("uid"))
    aged = active.select("uid", (F.col("date")).alias("day"),
                         first.alias("date")).withColumn("age", F.datediff("day", "date"))
    per = aged.groupBy("date").agg(
        F.count_if(F.col("age") == 0).alias("cohort_size"), F.max("day").alias("_last"),
        *[F.count_if(F.col("age") == n).alias(f"r{n}") for n in days])
    # one row per cohort day: the single window partition is bounded by the calendar
    per = per.withColumn("_last", F.max("_last").over(Window.partitionBy()))
    return per.select("date", "cohort_size",
                      *[F.when(F.date_add("date", n) <= F.col("_last"), safe_ratio(F.col(f"r{n}"), F.col("cohort_size")))
                        .alias(f"d{n}_retention") for n in days])


def dx_retention(sessions: DataFrame, x: int, date_col: str = "date",
                 first_col: str = "earliest_date") -> DataFrame:
    """Rows of age ``x`` / rows of age 0 on the same day."""
    age = F.datediff(date_col, first_col)
    per = sessions.groupBy(date_col).agg(
        F.count_if(age == x).alias("_rx"), F.count_if(age == 0).alias("_r0"))
    return per.select(date_col, safe_ratio(F.col("_rx"), F.col("_r0")).alias("dx_retention"))
