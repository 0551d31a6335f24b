"""Identity resolution."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TMP_PREFIX = "tmp_"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def funnel_identity(uid="uid", sid="_id") -> Column:
    """(a) null or empty uid -> the session/visitor id."""
    return F.coalesce(F.nullif(_c(uid), F.lit("")), _c(sid))


def combined_identity(uid="uid", sid="_id") -> Column:
    """(b) empty uid -> ``'tmp_' || _id``; null stays null."""
    u = _c(uid)
    return F.when(u == "", F.concat(F.lit(TMP_PREFIX), _c(sid))).otherwise(u)
