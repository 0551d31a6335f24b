"""Plan-shape guards for the scale design (read from ``explain`` output)."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as entry
from daypulse.plans import queries as core

SF = "/root/testdata/sf0.001"


def _plan(spark, name, mode="formatted"):
    df = entry.queries()[name](spark, SF)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(core.queries()))
def test_no_python_and_no_unbounded_nested_loops(spark, name):
    plan = _plan(spark, name)
    assert "EvalPython" not in plan and "PythonUDF" not in plan
    assert "CartesianProduct" not in plan
    if name != "geo_lookup":  # the opt-in broadcast form over a 25-row dimension
        assert "BroadcastNestedLoopJoin" not in plan


def test_interval_form_has_no_fan_out_or_distinct_count(spark):
    plan = _plan(spark, "active_users_interval")
    assert "Expand" not in plan and "count(distinct" not in plan.lower()
    explode = _plan(spark, "active_users_basics")
    assert "Expand" in explode  # the reference form, for comparison


def _nodes(plan):
    """(number, operator, details) of the numbered nodes; numbers grow from
    the scans upwards."""
    out = []
    for block in plan.split("\n\n"):
        m = re.match(r"\((\d+)\) (\w[\w ]*)", block.strip())
        if m:
            out.append((int(m.group(1)), m.group(2).strip(), block))
    return out


def test_explode_form_copies_counts_not_users(spark):
    nodes = _nodes(_plan(spark, "active_users_basics"))
    copied = max(n for n, op, body in nodes if op == "Generate" and "_off" in body)
    later = [body for n, op, body in nodes if op == "Exchange" and n > copied]
    assert later and all("uid" not in body for body in later)


def test_ordered_picks_combine_before_the_shuffle(spark):
    for name in ("user_day", "latest_per_key", "dedup_payments", "revenue_by_channel"):
        nodes = _nodes(_plan(spark, name))
        first_exchange = min(n for n, op, _ in nodes if op == "Exchange")
        partial = [n for n, op, body in nodes if "Aggregate" in op and "partial_m" in body]
        assert partial and min(partial) < first_exchange, name


def test_pushdown_and_pruning(spark):
    plan = _plan(spark, "scan_date_filter")
    assert "GreaterThanOrEqual(ts,2024-01-10T00:00)" in plan and "LessThan(ts,2024-01-21T00:00)" in plan
    star = _plan(spark, "star_relation")
    assert "Not(EqualTo(o_orderstatus,P))" in star
    assert "p_type" not in star and "c_acctbal" not in star  # unused columns not read
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in _plan(spark, "video_playbacks")


def test_ip_join_back_is_keyed_by_number(spark):
    nodes = _nodes(_plan(spark, "active_users_interval"))
    ip_joins = [body for _, op, body in nodes if op.endswith("Join") and "_ipn" in body]
    assert ip_joins and all("coalesce(ip" not in b and "isnull(ip" not in b for b in ip_joins)
    assert sum(1 for _, op, _ in nodes if op == "Window") == 3  # two of the interval form, one over the ranges


def _ran(spark, name):
    """The final adaptive plan after the query ran."""
    df = entry.queries()[name](spark, SF)
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", ["funnel_paths", "funnel_url_paths"])
def test_funnel_parses_the_events_once(spark, name):
    plan = _ran(spark, name)
    assert len(re.findall(r"FileScan parquet", plan)) == 1
    assert plan.count("collect_set") >= 1 and "Window" not in plan


@pytest.mark.parametrize("name", ["active_users_interval", "bi_basics_per_day", "bi_measures_long"])
def test_user_agents_need_no_scan_of_their_own(spark, name):
    plan = _plan(spark, name)
    scans = re.findall(r"Location: InMemoryFileIndex \[file:[^\]]*events\.parquet\]", plan)
    assert len(scans) == 1  # the rows are read once, the IPs join the ranges' pieces
    assert not re.search(r"Join.*\n.*u_a", plan)


def test_user_agent_fields_stay_in_one_stage(spark):
    assert "Exchange" not in _plan(spark, "ua_fields")
