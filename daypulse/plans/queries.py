"""Registered queries: one per operator of SURVEY §2 (``queries()``).

Each takes ``(spark, sf_dir)``, reads the whole test tables through the
adapters of :mod:`daypulse.fixtures`, and returns a DataFrame (no action).
Column names match the DuckDB oracles in :mod:`daypulse.plans.oracles`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daypulse import fixtures as fx
from daypulse import schemas
from daypulse.functions import labels
from daypulse.functions.net import ip_to_long
from daypulse.functions.urls import decode_url, path_param, with_url_fields
from daypulse.operators import activity, agent_rules, bi, commerce, distinct_store, dyadic, extra_fields, funnel, geo, logs, retention, sessions
from daypulse.operators.agents import UA_FIELDS, parse_user_agents
from daypulse.operators.identity import combined_identity, funnel_identity
from daypulse.operators.user_day import user_day, user_day_dims
from daypulse.sources.tables import ts_day_range

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixed parameters of registered queries.
DATE_FROM, DATE_TO = "2024-01-10", "2024-01-20"
SNAPSHOT_CUT = "2024-01-16"
XAU_DAYS = 7
DX_DAYS = 1
TOP_K = 3
SESSION_GAP = "3 hours"


def register(fn: Query) -> Query:
    """Register under the function name (a ``_query`` suffix is dropped)."""
    QUERIES[fn.__name__.removesuffix("_query")] = fn
    return fn


# ----------------------------------------------------------------- inputs
def _t(spark, sf_dir, name):
    return fx.table(spark, sf_dir, name)


def _client(spark, sf_dir) -> DataFrame:
    return fx.client_log(_t(spark, sf_dir, "events"))


def _server(spark, sf_dir) -> DataFrame:
    return logs.parse_server_lines(fx.server_line(_t(spark, sf_dir, "events")), keep=["event_id"])


def _payment(spark, sf_dir) -> DataFrame:
    return fx.payment(_t(spark, sf_dir, "lineitem"))


def _refund(spark, sf_dir) -> DataFrame:
    return fx.refund(_t(spark, sf_dir, "lineitem"))


def _geo(spark, sf_dir) -> DataFrame:
    return fx.geo_range(_t(spark, sf_dir, "nation"), _t(spark, sf_dir, "region"))


def _user_days(spark, sf_dir) -> DataFrame:
    return user_day(_client(spark, sf_dir), order_cols=("t", "event_id"))


def _user_dims(spark, sf_dir) -> DataFrame:
    return user_day_dims(_user_days(spark, sf_dir), _geo(spark, sf_dir))


def _sessions(spark, sf_dir) -> DataFrame:
    return sessions.sessions_table(_client(spark, sf_dir))


# ------------------------------------------------------- sources / parsing
@register
def json_extract(spark, sf_dir):
    """S3: JSON text -> typed columns with an explicit schema."""
    schema = T.StructType([T.StructField("k", T.LongType())])
    parsed = logs.parse_json(fx.event_json(_t(spark, sf_dir, "events")), "props", schema, keep=["event_id"])
    return parsed.select("event_id", "k", F.col(schemas.CORRUPT).isNotNull().alias("is_corrupt"))


@register
def extra_field_report(spark, sf_dir):
    """Fields outside the schema, kept as VARIANT, with types."""
    rows = fx.event_json_wide(_t(spark, sf_dir, "events"))
    return extra_fields.report(rows.select(extra_fields.extra("props", ["k"]).alias(extra_fields.EXTRA)), ["k"])


@register
def extra_field_values(spark, sf_dir):
    """Such fields read from the kept objects."""
    rows = fx.event_json_wide(_t(spark, sf_dir, "events")).withColumn(extra_fields.EXTRA, extra_fields.extra("props", ["k"]))
    for name, path, kind in (("seed", "ab.seed", "bigint"), ("tag", "tags[0]", "string"), ("ratio", "ratio", "double")):
        rows = extra_fields.with_field(rows, path, kind, name)
    return rows.select("event_id", "seed", "tag", "ratio")


@register
def server_log_parse(spark, sf_dir):
    """S4."""
    return _server(spark, sf_dir).select(
        "event_id", "date", F.col("actionType").alias("action_type"),
        F.col("studentId").alias("student_id"))


@register
def scan_date_filter(spark, sf_dir):
    """Day-range scan; the bounds reach the Parquet scan."""
    events = ts_day_range(_t(spark, sf_dir, "events"), "ts", DATE_FROM, DATE_TO)
    return fx.client_log(events).select("event_id", "date", "uid", "event_type")


@register
def client_landing(spark, sf_dir):
    """P1 + P2: required field filter and the day of the epoch time."""
    raw = _client(spark, sf_dir).select("event_id", "t", "uid", "_id")
    return logs.land_client_rows(raw).select("event_id", "date", "uid", "_id")


@register
def action_router(spark, sf_dir):
    """P3."""
    return (logs.with_route(_server(spark, sf_dir))
            .select("event_id", F.col("actionType").alias("action_type"), "route"))


@register
def video_playbacks(spark, sf_dir):
    """P4 + A15 (the minimum slice)."""
    return logs.video_playbacks(_client(spark, sf_dir))


@register
def identity_resolve(spark, sf_dir):
    """P6 (a) and (b)."""
    return _client(spark, sf_dir).select(
        "event_id", funnel_identity().alias("funnel_id"),
        combined_identity().alias("combined_id"))


@register
def pay_channel_label(spark, sf_dir):
    """P7."""
    return _payment(spark, sf_dir).select(
        "purchase_number", "line_no", "part_key", "supp_key", "pay_channel",
        labels.pay_channel_label("pay_channel").alias("channel_label"))


@register
def refund_status_code(spark, sf_dir):
    """Status code -> label (code 2 and unknown: to be verified)."""
    rows = logs.route(_refund(spark, sf_dir), "refund", "action_type")
    return (rows.groupBy("status", labels.refund_status_name("status").alias("status_name"))
            .agg(F.count(F.lit(1)).alias("cnt")))


@register
def money_truncate(spark, sf_dir):
    """P10: per-row truncation vs exact sum of cents."""
    return _payment(spark, sf_dir).groupBy("date").agg(
        F.sum(labels.cents_to_units("total_price")).alias("units_truncated"),
        (F.sum("total_price").cast("double") / 100).alias("units_exact"))


@register
def business_date(spark, sf_dir):
    """P11."""
    return _payment(spark, sf_dir).select(
        "purchase_number", "line_no", "part_key", "supp_key",
        labels.business_date("pay_date", "date").alias("business_date"))


@register
def refund_record(spark, sf_dir):
    """P13."""
    return logs.refund_records(_refund(spark, sf_dir))


# ------------------------------------------------------------ URL and UA
@register
def url_decode(spark, sf_dir):
    """F1."""
    return _client(spark, sf_dir).select("event_id", decode_url("url").alias("decoded"))


@register
def url_clean(spark, sf_dir):
    """F2 + F3."""
    return (with_url_fields(_client(spark, sf_dir), "url", fields=("clean", "is_wechat"))
            .select("event_id", F.col("clean").alias("path"), "is_wechat"))


@register
def url_steps_query(spark, sf_dir):
    """F4."""
    return with_url_fields(_client(spark, sf_dir), "url", fields=("steps",)).select("event_id", "steps")


@register
def path_param_query(spark, sf_dir):
    """F5 on the cleaned path."""
    rows = with_url_fields(_client(spark, sf_dir), "url", fields=("clean",), urls_only=True)
    return rows.select("event_id", path_param("clean", funnel.REPORT_PARAM).alias("report"))


@register
def ua_fields(spark, sf_dir):
    """F6 + F7."""
    rows = _client(spark, sf_dir).select("event_id", "u_a")
    return parse_user_agents(rows, "u_a").select("event_id", *UA_FIELDS)


@register
def ua_fields_by_rules(spark, sf_dir):
    """F7 by the table of rules, on a dozen kinds of agents."""
    rows = fx.agent_log(_t(spark, sf_dir, "events"))
    return agent_rules.parse_user_agents(rows, agent_rules.default_rules(spark)).select("event_id", *agent_rules.FIELDS)


@register
def ip_to_long_query(spark, sf_dir):
    """F8."""
    return _client(spark, sf_dir).select("event_id", "ip", ip_to_long("ip").alias("ip_num"))


# ---------------------------------------------------------------- geo J1
def _geo_query(spark, sf_dir, strategy):
    ips = _client(spark, sf_dir).select(F.col("ip").alias("_ip"))
    located = geo.locate_ips(ips, _geo(spark, sf_dir), strategy=strategy)
    return located.select(F.col("_ip").alias("ip"), F.col("_ipn").alias("ip_num"),
                          F.col("_location").alias("location"))


@register
def geo_lookup(spark, sf_dir):
    """J1 (a): broadcast range side (fixture dim: 25 ranges)."""
    return _geo_query(spark, sf_dir, "broadcast")


@register
def geo_lookup_bucketed(spark, sf_dir):
    """J1 (b): block-bucketed equi-join + residual BETWEEN."""
    return _geo_query(spark, sf_dir, "bucketed")


@register
def geo_lookup_dyadic(spark, sf_dir):
    """J1 (c): aligned prefixes, the IPv4 ranges of the other two."""
    ranges = dyadic.ipv4_ranges(_geo(spark, sf_dir))
    return dyadic.locate(_client(spark, sf_dir).select("ip"), ranges)


@register
def geo_lookup_any(spark, sf_dir):
    """J1 (c): IPv4 and IPv6, with ranges that overlap and one of all IPv4."""
    ranges = fx.any_range(_t(spark, sf_dir, "nation"), _t(spark, sf_dir, "region"))
    return dyadic.locate(fx.any_address(_t(spark, sf_dir, "events")), ranges)


# ------------------------------------------------------ user-day, actives
@register
def user_day_query(spark, sf_dir):
    """A1."""
    return _user_days(spark, sf_dir)


@register
def active_users_basics(spark, sf_dir):
    """A2, explode form."""
    return activity.active_users_explode(_user_dims(spark, sf_dir))


@register
def active_users_interval(spark, sf_dir):
    """A2, interval form (the flagship)."""
    return activity.active_users_interval(_user_dims(spark, sf_dir))


@register
def active_users_total(spark, sf_dir):
    """A2 over all dimensions: true distinct users per day."""
    return activity.active_users_total(_user_days(spark, sf_dir))


@register
def actives_by_bitmap(spark, sf_dir):
    """A2 + B9 from day bitmaps: in total, by each dimension, by all."""
    days = _user_dims(spark, sf_dir)
    return distinct_store.actives(distinct_store.day_bitmaps(days, distinct_store.number_users(days)))


@register
def url_reach_sketched(spark, sf_dir):
    """A5 + B8 over a range of days from day sketches, beside the exact
    counts: whether each estimate keeps its stated bound."""
    rows = _client(spark, sf_dir).select("date", funnel_identity().alias("uid"), "url")
    found = distinct_store.reach(distinct_store.day_sketches(rows, "url"), DATE_FROM, DATE_TO)
    own = rows.where(F.col("date").between(F.lit(DATE_FROM).cast("date"), F.lit(DATE_TO).cast("date")) & F.col("url").isNotNull())
    exact = own.distinct().groupBy("url").agg(F.count_distinct("uid").alias("users"))
    off = F.abs(F.col("estimate") - F.col("users"))
    return exact.join(found.select(F.col("step").alias("url"), F.col("users").alias("estimate")), "url").select(
        "url", "users", (off <= F.greatest(F.lit(1), F.col("users") * distinct_store.error_bound())).alias("within_bound"))


@register
def first_visit(spark, sf_dir):
    """A8."""
    return activity.first_visit(_user_days(spark, sf_dir))


@register
def high_water_mark(spark, sf_dir):
    """A9."""
    return activity.high_water_mark(_user_days(spark, sf_dir))


@register
def user_age(spark, sf_dir):
    """J2."""
    return retention.user_age(_user_days(spark, sf_dir))


@register
def retention_d1_d7_d30(spark, sf_dir):
    """A10, one pass."""
    return retention.retention(_user_days(spark, sf_dir))


@register
def retention_full_outer(spark, sf_dir):
    """J3 + J4, the join-chain form."""
    return retention.retention_join_chain(_user_days(spark, sf_dir))


@register
def retention_cohort(spark, sf_dir):
    """Cohort retention of customers by order day."""
    sparse = fx.user_day_sparse(_t(spark, sf_dir, "orders")).select(
        "date", F.col("uid").cast("string").alias("uid"))
    return retention.cohort_retention(sparse)


# ---------------------------------------------------------------- funnel
@register
def open_distribution(spark, sf_dir):
    """A3."""
    return funnel.open_distribution(_client(spark, sf_dir))


@register
def distinct_steps(spark, sf_dir):
    """A4."""
    return funnel.distinct_steps(_client(spark, sf_dir))


@register
def url_reach(spark, sf_dir):
    """A5."""
    return funnel.url_reach(funnel.distinct_steps(_client(spark, sf_dir)))


def _funnel_pairs(spark, sf_dir) -> DataFrame:
    rows = _client(spark, sf_dir)
    user = F.concat(funnel_identity(), F.lit("@"), F.col("date").cast("string"))
    return rows.select(user.alias("uid"), F.col("event_type").alias("url")).distinct()


@register
def funnel_paths(spark, sf_dir):
    """A6 (+O2): key ``user@date``, step = event type (FIXTURES.md)."""
    return funnel.funnel_paths(_funnel_pairs(spark, sf_dir))


@register
def funnel_url_paths(spark, sf_dir):
    """A6 on URL steps per resolved user (the reference's own data flow)."""
    return funnel.funnel_paths(funnel.user_steps(_client(spark, sf_dir)))


@register
def top_urls(spark, sf_dir):
    """O3: top-k report."""
    reach = funnel.url_reach(funnel.distinct_steps(_client(spark, sf_dir)))
    return funnel.top_steps(reach, TOP_K)


@register
def page_url_fields(spark, sf_dir):
    """F1-F5 on the URLs of pages."""
    rows = with_url_fields(fx.page_view(_t(spark, sf_dir, "pages")), "url", fields=("clean", "is_wechat", "steps"))
    return rows.select("event_id", F.col("clean").alias("path"), "is_wechat", "steps", path_param("clean", "en").alias("en"))


@register
def page_funnels(spark, sf_dir):
    """A4 -> A6 on the URLs of pages."""
    return funnel.funnel_paths(funnel.user_steps(fx.page_view(_t(spark, sf_dir, "pages"))))


# -------------------------------------------------------------- commerce
@register
def latest_per_key(spark, sf_dir):
    """A7."""
    return commerce.latest_per_key(
        _payment(spark, sf_dir), ["purchase_number"], fx.PAYMENT_ORDER,
        ["line_no", "part_key", "supp_key", "total_price", "pay_channel", "date"])


@register
def revenue_by_channel(spark, sf_dir):
    """A12."""
    return commerce.revenue_by_channel(_payment(spark, sf_dir), fx.PAYMENT_ORDER)


@register
def refund_by_status(spark, sf_dir):
    """A11 (+P8)."""
    return commerce.refund_by_status(_refund(spark, sf_dir))


@register
def signup_by_class(spark, sf_dir):
    """A13 (+P12)."""
    return commerce.signup_by_class(fx.signup(_t(spark, sf_dir, "part")))


@register
def students_by_day(spark, sf_dir):
    """A14."""
    return commerce.students_by_day(fx.student(_t(spark, sf_dir, "events")))


@register
def dedup_payments(spark, sf_dir):
    """A16, payments."""
    return commerce.dedup_payments(_payment(spark, sf_dir), fx.PAYMENT_ORDER)


@register
def dedup_refunds(spark, sf_dir):
    """A16, refunds."""
    return commerce.dedup_refunds(_refund(spark, sf_dir))


@register
def star_relation(spark, sf_dir):
    """J6."""
    return commerce.class_relation(*fx.class_relation_tables(lambda name: _t(spark, sf_dir, name)))


# -------------------------------------------------------------- sessions
@register
def session_rollup(spark, sf_dir):
    """T3, batch form."""
    return sessions.session_rollup(_client(spark, sf_dir))


@register
def session_datapoints(spark, sf_dir):
    """T4, corrected."""
    return sessions.session_datapoints(sessions.session_rollup(_client(spark, sf_dir)))


@register
def sessions_by_gap(spark, sf_dir):
    """Sessions by silence."""
    return sessions.sessions_by_gap(_client(spark, sf_dir), SESSION_GAP)


@register
def sessions_with_age(spark, sf_dir):
    """T5 + J5."""
    return _sessions(spark, sf_dir)


@register
def sessions_snapshot(spark, sf_dir):
    """A17 over a log holding the states after two batches (a day cut)."""
    rows = _client(spark, sf_dir)
    first = sessions.sessions_table(rows.filter(F.col("date") < F.lit(SNAPSHOT_CUT).cast("date")))
    return sessions.snapshot(first.unionByName(sessions.sessions_table(rows)))


@register
def new_users(spark, sf_dir):
    """A18 / B4."""
    return sessions.new_users(_sessions(spark, sf_dir))


@register
def active_datapoints(spark, sf_dir):
    """A19 / U1."""
    return sessions.active_datapoints(_sessions(spark, sf_dir))


@register
def returning_counts(spark, sf_dir):
    """A20."""
    return sessions.returning_counts(_sessions(spark, sf_dir))


@register
def rows_to_json(spark, sf_dir):
    """K8: rows -> JSON text (the backup-topic payload)."""
    swa = _sessions(spark, sf_dir)
    return swa.select(F.to_json(F.struct(*swa.columns)).alias("value"))


# -------------------------------------------------------------------- BI
@register
def xau_param(spark, sf_dir):
    """B1 / W1 with X = 7."""
    return bi.xau(_sessions(spark, sf_dir), XAU_DAYS)


@register
def dx_retention(spark, sf_dir):
    """B3 with X = 1."""
    return retention.dx_retention(_sessions(spark, sf_dir), DX_DAYS)


@register
def session_time_avg(spark, sf_dir):
    """B5."""
    return bi.session_time_avg(_sessions(spark, sf_dir))


@register
def sessions_avg(spark, sf_dir):
    """B6."""
    return bi.sessions_avg(_sessions(spark, sf_dir))


@register
def sessions_total(spark, sf_dir):
    """B7."""
    return bi.sessions_total(_sessions(spark, sf_dir))


@register
def users_per_day(spark, sf_dir):
    """B8."""
    return bi.users_per_day(_sessions(spark, sf_dir))


@register
def bi_basics_per_day(spark, sf_dir):
    """The A2 table summed over its dimensions, per day (rolled up from
    the A2 events directly; equals ``basics_per_day`` of the A2 table)."""
    return activity.active_users_dims_summed(_user_dims(spark, sf_dir))


@register
def bi_measures_long(spark, sf_dir):
    """B10 (+F13)."""
    return bi.measures_long(activity.active_users_dims_summed(_user_dims(spark, sf_dir)))


@register
def dense_calendar(spark, sf_dir):
    """First orders per day, every day of the range shown."""
    per_day = (activity.first_visit(fx.user_day_sparse(_t(spark, sf_dir, "orders")))
               .groupBy(F.col("earliest_date").alias("date"))
               .agg(F.count(F.lit(1)).alias("first_visits")))
    return bi.full_range(per_day, ["first_visits"])


def queries() -> dict[str, Query]:
    return dict(QUERIES)
