"""Active users: DAU / WAU / MAU by dimensions (A2), totals, first visit
(A8), high-water mark (A9), and the trailing-window helpers B1 and B12 use.

Two forms of A2 are kept and must give identical rows:

* :func:`active_users_explode` — the reference's formulation: active days
  are copied to the next 30 days. The distinct users and sessions of a dims
  tuple and day are counted before the copies, so the 31x fan-out is that of
  the (dims, day) pairs, not of the user-days.
* :func:`active_users_interval` — the scale form. "Users active in the
  trailing N days" is a union of intervals: an active day ``d`` of an
  entity covers ``[d, min(next active day, d + N))``. Each interval adds +1
  at its start and -1 at its end; a running sum per dims tuple over the
  days gives the distinct count. No fan-out, no ``count(distinct)``: the
  shuffles carry ~4 rows per (user, dims, active day), and every window
  partition holds at most one row per calendar day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daypulse.schemas import BASIC_DIMS

# Window lengths of the active-user table. Day d's WAU counts
# days d-7 .. d (8 days) and MAU days d-30 .. d (31 days), inclusive.
DAU_DAYS = 1
WAU_DAYS = 8
MAU_DAYS = 31
HORIZON = MAU_DAYS - 1


def _dims(dims) -> list[str]:
    return list(BASIC_DIMS if dims is None else dims)


# ------------------------------------------------------------ explode form
def active_users_explode(user_dims: DataFrame, dims=None) -> DataFrame:
    """A2, reference formulation (each active day copied to the next 30).

    One read of ``user_dims`` gives the distinct (dims, date, uid) and
    (dims, date, _id). Copies of a user's day beyond the user's next active
    day in the same dims would count the user a second time, so each day is
    copied up to that one only and the distinct counts become sums. User-days
    of equal dims, date and number of copies are counted first, then copied:
    no shuffle carries copies of users.

    A null uid is no user, but its days make rows too. A day without a date
    has all its copies on the null date and counts there once.
    """
    d = _dims(dims)
    days = user_dims.select(*d, F.col("date").cast("date").alias("date"), "uid", "_id")
    keys = [*d, "date", "uid", "_id"]
    tagged = days.groupingSets(
        [[F.col(c) for c in [*d, "date", "uid"]], [F.col(c) for c in [*d, "date", "_id"]]], *keys,
    ).agg((F.grouping("_id") == 1).alias("_user"))
    tagged = tagged.filter(F.col("_user") | F.col("_id").isNotNull())
    gap = F.datediff(F.lead("date").over(Window.partitionBy("uid", "_id", *d).orderBy("date")), "date")
    once = ~F.col("_user") | F.col("date").isNull()
    counts = (tagged.withColumn("_n", F.when(once, 1).otherwise(F.least(gap, F.lit(MAU_DAYS))))
              .groupBy(*d, "date", "_n").agg(F.count("uid").alias("_users"), F.count("_id").alias("_sessions")))
    off = F.col("_off")
    copies = counts.select(
        *d, "_users", "_sessions",
        F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_off"),
        "date")
    copies = copies.withColumn("date", F.date_add("date", off))

    def total(within: Column, n: str) -> Column:
        return F.coalesce(F.sum(F.when(within, F.col(n))), F.lit(0).cast("bigint"))

    return copies.groupBy("date", *d).agg(
        total(off == 0, "_sessions").alias("sessions"),
        total(off < DAU_DAYS, "_users").alias("dau"),
        total(off < WAU_DAYS, "_users").alias("wau"),
        total(off < MAU_DAYS, "_users").alias("mau"))


# ----------------------------------------------------------- interval form
def _expand_spans(totals: DataFrame, group: list[str], running: list[str],
                  point: list[str], keep: Column, carry=()) -> DataFrame:
    """Running sums per group over the delta days, then one output row per
    calendar day from each delta day up to the next one (rows where ``keep``
    holds). ``point`` columns are per-day values, not running."""
    w = Window.partitionBy(*group).orderBy("day")
    cum = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rolled = totals.select(
        *group, "day", *point, *carry,
        *[F.sum(c).over(cum).alias(c) for c in running],
        F.lead("day").over(w).alias("_next"))
    rolled = rolled.filter(keep)
    k = F.col("_k")
    expanded = rolled.select(
        *group, "day", *point, *running, *carry,
        F.explode(F.sequence(F.lit(0), F.datediff("_next", "day") - 1)).alias("_k"))
    return expanded.select(
        F.date_add("day", k).alias("date"), *group,
        *[F.when(k == 0, F.col(c)).otherwise(F.lit(0)).cast("bigint").alias(c) for c in point],
        *[F.col(c).cast("bigint").alias(c) for c in running], *carry)


def _activity_events(user_dims: DataFrame, d: list[str]) -> DataFrame:
    """The +1/-1 events of A2 (columns: dims..., day, dau, wau, mau,
    _exists, sessions) from one read of ``user_dims``.

    Each row is tagged three ways — ``u`` (its uid; null uids skipped),
    ``e`` (the dims tuple exists that day) and ``s`` (its session id) — and
    de-duplicated with a map-side-combined aggregation, so a hot dims tuple
    or user is reduced to one row per day before any shuffle. One ``lead``
    window per (tag, key, dims) turns each active day into events:

    * ``u``: dau/wau/mau with N = 1/8/31 over distinct (uid, dims, date);
    * ``e``: ``_exists`` with N = 31 (the output has a row for each dims
      tuple up to 30 days after its last activity, zeros included);
    * ``s``: ``sessions`` +1 on the day (distinct session ids).
    """
    metrics = {"dau": DAU_DAYS, "wau": WAU_DAYS, "mau": MAU_DAYS}
    names = [*metrics, "_exists", "sessions"]
    tags = F.array(
        F.struct(F.lit("u").alias("tag"), F.col("uid").cast("string").alias("key")),
        F.struct(F.lit("e").alias("tag"), F.lit(None).cast("string").alias("key")),
        F.struct(F.lit("s").alias("tag"), F.col("_id").cast("string").alias("key")))
    tagged = (user_dims.select(*d, "date", F.explode(tags).alias("_t"))
              .select(*d, "date", "_t.tag", "_t.key")
              .filter((F.col("tag") != "u") | F.col("key").isNotNull())
              .distinct())
    w = Window.partitionBy("tag", "key", *d).orderBy("date")
    nxt = tagged.select(*d, "date", "tag", F.lead("date").over(w).alias("_next"))
    day, tag, nx = F.col("date"), F.col("tag"), F.col("_next")

    def event(at, **vals):
        return F.struct(at.alias("day"), *[F.lit(vals.get(n, 0)).cast("bigint").alias(n) for n in names])

    def stop(n):
        end = F.date_add(day, n)
        return F.when(nx.isNotNull() & (nx < end), nx).otherwise(end)

    user_events = F.array(event(day, dau=1, wau=1, mau=1),
                          *[event(stop(n), **{m: -1}) for m, n in metrics.items()])
    exist_events = F.array(event(day, _exists=1), event(stop(MAU_DAYS), _exists=-1))
    session_events = F.array(event(day, sessions=1))
    events = (F.when(tag == "u", user_events).when(tag == "e", exist_events)
              .otherwise(session_events))
    return nxt.select(*d, F.explode(events).alias("_e")).select(*d, "_e.*")


_METRICS = ["dau", "wau", "mau"]


def _rolled(events: DataFrame, group: list[str]) -> DataFrame:
    totals = events.groupBy(*group, "day").agg(
        *[F.sum(c).alias(c) for c in [*_METRICS, "_exists", "sessions"]])
    out = _expand_spans(totals, group, [*_METRICS, "_exists"], ["sessions"], F.col("_exists") > 0)
    return out.select("date", *group, "sessions", *_METRICS)


def active_users_interval(user_dims: DataFrame, dims=None) -> DataFrame:
    """A2, scale form (same rows as :func:`active_users_explode`): the
    events of :func:`_activity_events`, one aggregation per (dims, day) and
    one running-sum window per dims tuple."""
    d = _dims(dims)
    return _rolled(_activity_events(user_dims, d), d)


def active_users_dims_summed(user_dims: DataFrame, dims=None) -> DataFrame:
    """A2 summed over its dimensions per day (what B9 shows), without
    building the per-dims table: a sum over dims of running sums is the
    running sum of the per-day summed events. Equals
    ``basics_per_day(active_users_interval(user_dims, dims))``."""
    return _rolled(_activity_events(user_dims, _dims(dims)), [])


def active_users_total(user_dims: DataFrame) -> DataFrame:
    """True DAU/WAU/MAU per day over all dimensions (distinct users)."""
    return active_users_interval(user_dims, dims=[])


# ------------------------------------------------------------------ others
def first_visit(user_days: DataFrame, uid: str = "uid") -> DataFrame:
    """First active day per user (null uid has none)."""
    return (user_days.filter(F.col(uid).isNotNull())
            .groupBy(uid).agg(F.min("date").alias("earliest_date")))


def high_water_mark(user_days: DataFrame) -> DataFrame:
    """The last closed day, ``max(date) - 1`` (one row)."""
    return user_days.agg(F.date_sub(F.max("date"), 1).alias("processed_until"))


def since_mark(rows: DataFrame, mark: str, look_back_days: int = HORIZON) -> DataFrame:
    """A9 applied: rows a re-run must read after ``mark`` (inclusive of the
    look-back A2 needs to rebuild the trailing windows of new days)."""
    start = F.date_sub(F.lit(mark).cast("date"), look_back_days)
    return rows.filter(F.col("date") > start)


def trailing_active(active: DataFrame, entity: str, x: int,
                    date_col: str = "date") -> DataFrame:
    """B1: per calendar day from the first to the last active day, the
    number of distinct entities active in the trailing ``x`` days.

    Each distinct (entity, day) gives +1 at the day (flagged as an active
    day) and -1 when its interval ends; the per-day sums are aggregated
    before the (global) running sum, so the single window partition holds
    one row per calendar day.
    """
    pairs = active.select(entity, date_col).distinct()
    w = Window.partitionBy(entity).orderBy(date_col)
    nxt = pairs.select(date_col, F.lead(date_col).over(w).alias("_next"))
    d, nx = F.col(date_col), F.col("_next")
    end = F.date_add(d, x)
    stop = F.when(nx.isNotNull() & (nx < end), nx).otherwise(end)
    events = F.array(F.struct(d.alias("day"), F.lit(1).alias("xau"), F.lit(1).alias("_active")),
                     F.struct(stop.alias("day"), F.lit(-1).alias("xau"), F.lit(0).alias("_active")))
    totals = (nxt.select(F.explode(events).alias("_e")).select("_e.*")
              .groupBy("day").agg(F.sum("xau").alias("xau"), F.max("_active").alias("_active")))
    last = F.max(F.when(F.col("_active") > 0, F.col("day"))).over(Window.partitionBy())
    totals = totals.withColumn("_last", last).drop("_active")
    spans = _expand_spans(totals, [], ["xau"], [], F.col("day") <= F.col("_last"),
                          carry=["_last"])
    return spans.filter(F.col("date") <= F.col("_last")).select("date", "xau")


def dense_calendar(per_day: DataFrame, value_cols, date_col: str = "date",
                   fill=0) -> DataFrame:
    """Every day between the first and the last day appears; missing
    days get ``fill``.

    ``per_day`` has one row per day, so a single ordered window over it is
    bounded by the calendar; each row is expanded up to the next present
    day (one read of the input, no join)."""
    nxt = F.lead(date_col).over(Window.orderBy(date_col))
    rows = per_day.select(date_col, *value_cols,
                          F.coalesce(nxt, F.date_add(date_col, 1)).alias("_next"))
    k = F.col("_k")
    spans = rows.select(date_col, *value_cols,
                        F.explode(F.sequence(F.lit(0), F.datediff("_next", date_col) - 1)).alias("_k"))
    return spans.select(F.date_add(date_col, k).alias(date_col),
                        *[F.when(k == 0, F.col(c)).otherwise(F.lit(fill)).alias(c) for c in value_cols])
