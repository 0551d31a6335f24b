"""F6 + F7 on a table: the user-agent fields of every row.

The rule chain is a Catalyst expression, so it runs where the rows are: no
shuffle on the (heavily skewed) user-agent string, no second scan for its
distinct values and no join back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypulse.functions.agents import ua_struct

UA_FIELDS = ("device", "os", "os_version", "language", "network", "browser")


def parse_user_agents(df: DataFrame, ua_col: str = "u_a") -> DataFrame:
    """Add the UA fields of F6/F7 to ``df``."""
    return df.select("*", ua_struct(ua_col).alias("_p")).select(*df.columns, *[F.col(f"_p.{f}").alias(f) for f in UA_FIELDS])
