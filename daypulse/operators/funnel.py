"""Report histogram (A3), distinct steps (A4), reach (A5), popularity-ordered
funnels (A6) and the top-k report (O3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypulse.functions.urls import path_param, with_url_fields
from daypulse.operators.identity import funnel_identity

REPORT_PARAM = "homeWorkReport"
STEP_SEPARATOR = ">"


def user_urls(client_rows: DataFrame, by=()) -> DataFrame:
    """Rows ``n`` per distinct (user, raw url), and per column in ``by``: the
    URL parse then runs once per pair instead of once per event (partial
    aggregation before the shuffle)."""
    return (client_rows.groupBy(*by, funnel_identity().alias("uid"), F.col("url"))
            .agg(F.count(F.lit(1)).alias("n")))


def _user_urls(rows: DataFrame, counted: bool) -> DataFrame:
    # ``counted``: rows of a stored :func:`user_urls` table
    return rows.groupBy("uid", "url").agg(F.sum("n").alias("n")) if counted else user_urls(rows)


def open_distribution(client_rows: DataFrame, param: str = REPORT_PARAM, counted: bool = False) -> DataFrame:
    """A3: how many (report, user) pairs opened a report n times, by n.

    Rows that name no report end before the second shuffle, by a generator
    over zero or one report id: a filter on a parsed column would be
    pushed below the projections with the parse inlined into it."""
    parsed = with_url_fields(_user_urls(client_rows, counted), "url", fields=("clean",), urls_only=True)
    named = F.array_compact(F.array(F.when(F.col("clean").contains(param), path_param("clean", param))))
    per_pair = (parsed.select(F.explode(named).alias("report"), "uid", "n")
                .groupBy("report", "uid").agg(F.sum("n").alias("times_opened")))
    return per_pair.groupBy("times_opened").agg(F.count(F.lit(1)).alias("cnt")).orderBy("times_opened")


def user_steps(client_rows: DataFrame, counted: bool = False) -> DataFrame:
    """The (user, step) pairs of A4 before the last distinct: a pair repeats
    when two URLs clean to one step. Enough for :func:`funnel_lists`."""
    pairs = _user_urls(client_rows, counted).select("uid", "url")
    return (with_url_fields(pairs, "url", fields=("steps",), urls_only=True)
            .select("uid", F.col("steps").alias("url")))


def distinct_steps(client_rows: DataFrame) -> DataFrame:
    """A4: distinct (user, step) pairs; rows without a parsable URL drop."""
    return user_steps(client_rows).distinct()


def url_reach(pairs: DataFrame, user: str = "uid", step: str = "url",
              approx_rsd: float | None = None) -> DataFrame:
    """A5: distinct users per step, most reached first.

    ``pairs`` are distinct, so a plain count is the distinct-user count and
    partial aggregation applies. With ``approx_rsd`` the pairs need not be
    distinct: a HyperLogLog++ sketch per step (relative standard deviation
    ``approx_rsd``) replaces the distinct shuffle."""
    users = (F.approx_count_distinct(F.col(user), approx_rsd) if approx_rsd
             else F.count(F.col(user)))
    return (pairs.groupBy(step).agg(users.alias("reach"))
            .orderBy(F.desc("reach"), F.asc(step)))


def funnel_lists(pairs: DataFrame, user: str = "uid", step: str = "url") -> DataFrame:
    """Each user's set of steps ordered by global reach (desc, ties by
    step asc) as an array ``funnel``, and the users with it.

    One pass over ``pairs`` (user, step; repeats allowed): users become their
    set of steps, equal sets are counted, and reach, join and ordering work on
    the distinct sets with their counts, which are far fewer than the users. A
    user's set is bounded by the step vocabulary.
    """
    sets = (pairs.filter(F.col(step).isNotNull())
            .groupBy(user).agg(F.array_sort(F.collect_set(step)).alias("_set"))
            # a null user has a funnel but does not count as reached
            .groupBy("_set", F.col(user).isNull().alias("_nobody")).agg(F.count(F.lit(1)).alias("_n")))
    each = sets.select("_set", "_nobody", "_n", F.explode("_set").alias("_s"))
    reach = each.groupBy("_s").agg(F.sum(F.when(F.col("_nobody"), 0).otherwise(F.col("_n"))).alias("_reach"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("_reach")).alias("k"), F.col("_s").alias("s"))))
    return (each.join(reach, "_s").groupBy("_set", "_nobody").agg(F.max("_n").alias("_n"), ordered.alias("_steps"))
            .groupBy(F.transform("_steps", lambda e: e["s"]).alias("funnel")).agg(F.sum("_n").alias("cnt")))


def funnel_paths(pairs: DataFrame, user: str = "uid", step: str = "url") -> DataFrame:
    """A6 as text: the lists of :func:`funnel_lists` joined with ``>`` (lists
    that read the same count together)."""
    lists = funnel_lists(pairs, user, step)
    return (lists.groupBy(F.array_join("funnel", STEP_SEPARATOR).alias("funnel")).agg(F.sum("cnt").alias("cnt"))
            .orderBy(F.desc("cnt"), F.asc("funnel")))


def top_steps(reach: DataFrame, k: int = 10, step: str = "url") -> DataFrame:
    """O3: the k most reached steps (TakeOrderedAndProject; ties by step)."""
    return reach.orderBy(F.desc("reach"), F.asc(step)).limit(k)
