"""A1: session rows -> one row per (date, uid, _id) with the latest values,
plus the dimension enrichment used by the active-user table (A2).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daypulse.functions.urls import with_url_fields
from daypulse.operators.agents import parse_user_agents
from daypulse.operators.geo import with_location

USER_DAY_VALUES = ("app_id", "is_wechat", "resolution", "u_a", "ip")


def latest_non_null(col: str, order_cols) -> Column:
    """Value of ``col`` on the latest row where it is not null; the value
    itself breaks remaining ties, so the pick never depends on row order."""
    row = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_cols)],
                   F.col(col).alias("_v"))
    return F.max(F.when(F.col(col).isNotNull(), row))["_v"].alias(col)


def user_day(client_rows: DataFrame, order_cols=("t",)) -> DataFrame:
    """A1: group by (date, uid, _id); keep the latest non-null app, in-app
    flag, resolution, user agent and IP. "Latest" is by event time with the
    remaining order columns as tie-break, so the result is deterministic.

    A grouped aggregate (partial on the map side), not a window: a key that
    holds a third of the rows is combined before the shuffle.
    """
    rows = with_url_fields(client_rows, "url", fields=("is_wechat",)).select(
        "date", "uid", "_id", "app_id", "is_wechat",
        F.col("res").alias("resolution"), "u_a", "ip", *order_cols)
    return rows.groupBy("date", "uid", "_id").agg(
        *[latest_non_null(c, order_cols) for c in USER_DAY_VALUES])


def user_day_dims(user_days: DataFrame, geo_ranges: DataFrame,
                  geo_strategy: str = "disjoint", keys: DataFrame | None = None) -> DataFrame:
    """User-day rows with location and user-agent dimensions (A2 input).

    The location comes from ranges cut into disjoint pieces, so the user-days
    are read once and keep their order of magnitude. The other strategies look
    up distinct IPs, taken from ``keys`` (column ``ip``; default: ``user_days``).
    User agents are parsed in place."""
    located = with_location(user_days, geo_ranges, "ip", "loc", strategy=geo_strategy, keys=keys)
    return parse_user_agents(located, "u_a")
