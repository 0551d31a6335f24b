"""Date and time expressions (P2, F9-F13). All are Catalyst expressions.

Epoch values are turned into calendar days without going through the
session time zone: the day is computed in an explicit zone (default UTC),
so the same data gives the same days on every cluster.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_millis(ts_ntz) -> Column:
    """Epoch milliseconds of a ``timestamp_ntz`` value, truncated."""
    return F.timestamp_diff("MILLISECOND", _epoch(), _c(ts_ntz).cast("timestamp_ntz"))


def millis_to_date(ms, tz: str = "UTC") -> Column:
    """Calendar day (in zone ``tz``) of an epoch-millisecond value."""
    wall_utc = F.timestamp_add("MILLISECOND", _c(ms), _epoch())
    if tz.upper() != "UTC":
        wall_utc = F.convert_timezone(F.lit("UTC"), F.lit(tz), wall_utc)
    return F.to_date(wall_utc)


#: Epoch milliseconds of 1970-01-01 and 3000-01-01: a client clock outside is wrong.
MILLIS_FROM, MILLIS_TO = 0, 32_503_680_000_000


def plausible_millis(ms) -> Column:
    """Whether an epoch-millisecond value is a day that can be stored."""
    return F.coalesce(_c(ms).between(MILLIS_FROM, MILLIS_TO - 1), F.lit(False))


def shift_days(date_col, n) -> Column:
    """date + n days (calendar arithmetic, DST-safe)."""
    return F.date_add(_c(date_col), n if isinstance(n, Column) else F.lit(n))


def day_age(date_col, first_col) -> Column:
    """whole days between the first day and this day."""
    return F.datediff(_c(date_col), _c(first_col))


def ms_to_seconds(ms) -> Column:
    """``INT(x)/1000`` — integer milliseconds to fractional seconds."""
    return _c(ms).cast("bigint") / F.lit(1000.0)


def safe_ratio(num, den) -> Column:
    """count/count as double; null when the denominator is 0 or null."""
    return F.try_divide(_c(num).cast("double"), F.nullif(_c(den).cast("double"), F.lit(0.0)))


def day_trunc(col) -> Column:
    """day truncation of a date or timestamp, as a date."""
    return F.to_date(_c(col))
