"""F7 by a table of rules: user agents -> device, system, browser.

A rule is a row (kind, priority, token, pattern, value): of the rules of a kind
whose pattern an agent matches the one with the least priority gives the value,
in which ``$1`` stands for the pattern's first group. ``token`` is a word that
any such agent holds (lower case). Distinct agents are cut into their words once
and joined with the rules on the token, so an agent meets only the few patterns
that can match it, however long the table grows, and the table is data: it comes
from a file (``daypulse/data/agent_rules.tsv``, or the caller's own) and not from
code.

The answer is joined back by the agent's text; AQE splits a hot agent. For a
handful of rules :func:`daypulse.operators.agents.parse_user_agents` works in
place without a join.
"""

from __future__ import annotations

import csv
from importlib.resources import files

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypulse.functions.agents import OTHER, UNKNOWN_DEVICE, net_type, ua_language

SCHEMA = "kind string, priority int, token string, pattern string, value string"
KINDS = ("device", "os", "major", "browser")
FIELDS = ("device", "os", "os_version", "language", "network", "browser")


def default_rules(spark: SparkSession) -> DataFrame:
    """The rules that come with the package."""
    with files("daypulse").joinpath("data/agent_rules.tsv").open(encoding="utf-8") as f:
        rows = list(csv.DictReader(f, delimiter="\t", quoting=csv.QUOTE_NONE))
    return spark.createDataFrame([(r["kind"], int(r["priority"]), r["token"], r["pattern"], r["value"]) for r in rows], SCHEMA)


def parse_distinct(agents: DataFrame, rules: DataFrame, ua_col: str = "u_a") -> DataFrame:
    """One row for each distinct agent (null too): the agent and ``FIELDS``."""
    known = agents.select(F.col(ua_col).alias("_ua")).distinct()
    words = F.array_distinct(F.split(F.lower("_ua"), "[^a-z0-9]+"))
    met = known.select("_ua", F.explode(words).alias("token")).join(rules, "token").where(F.expr("regexp_like(_ua, pattern)"))
    value = F.when(F.instr("value", "$1") > 0, F.expr("replace(value, '$1', regexp_extract(_ua, pattern, 1))")).otherwise(F.col("value"))
    row = F.struct("priority", value.alias("value"))
    best = met.groupBy("_ua").agg(*[F.min(F.when(F.col("kind") == k, row))["value"].alias(f"_{k}") for k in KINDS])
    found = known.join(best, "_ua", "left")  # a null agent meets no rule
    os = F.coalesce("_os", F.lit(OTHER))
    return found.select(F.col("_ua").alias(ua_col), F.coalesce("_device", F.lit(UNKNOWN_DEVICE)).alias("device"), os.alias("os"),
                        F.concat(os, F.lit(" "), F.coalesce("_major", F.lit(""))).alias("os_version"),
                        ua_language("_ua").alias("language"), net_type("_ua").alias("network"),
                        F.coalesce("_browser", F.lit(OTHER)).alias("browser"))


def parse_user_agents(df: DataFrame, rules: DataFrame, ua_col: str = "u_a") -> DataFrame:
    """Add ``FIELDS`` to every row of ``df``."""
    found = parse_distinct(df, rules, ua_col).withColumnRenamed(ua_col, "_agent")
    return df.join(found, df[ua_col].eqNullSafe(found["_agent"]), "left").select(*[df[c] for c in df.columns], *FIELDS)


def check_rules(rules: DataFrame) -> DataFrame:
    """Rules that can never apply or have no defined order: a token that is no
    single lower-case word, an unknown kind, or a priority that two rules share."""
    twice = rules.groupBy("kind", "priority").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    odd = rules.where(~F.col("token").rlike("^[a-z0-9]+$") | ~F.col("kind").isin(*KINDS))
    return odd.unionByName(rules.join(twice.drop("_n"), ["kind", "priority"], "left_semi").select(*rules.columns)).distinct()
