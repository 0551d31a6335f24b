"""A10 one pass == join chain, cohort retention, funnel ties, commerce rules."""

import datetime as dt

from pyspark.sql import functions as F

from daypulse import fixtures as fx
from daypulse.operators import commerce, funnel, retention

D0 = dt.date(2024, 1, 1)


def _d(n):
    return D0 + dt.timedelta(days=n)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


UD = "date date, uid string, _id string"


def _user_days(spark):
    rows = [(_d(0), "a", "s1"), (_d(0), "a", "s2"), (_d(0), "b", "s3"), (_d(1), "a", "s4"),
            (_d(1), None, "s5"), (_d(7), "b", "s6"), (_d(7), "c", "s7"), (_d(8), "c", "s8"),
            (_d(30), "a", "s9"), (_d(3), "d", "s10")]
    return spark.createDataFrame(rows, UD)


def test_retention_one_pass_equals_join_chain(spark):
    ud = _user_days(spark)
    one = _rows(retention.retention(ud))
    chain = _rows(retention.retention_join_chain(ud).select(
        "date", "d1_retention", "d7_retention", "d30_retention"))
    assert one == chain
    by_day = {r[0]: r[1:] for r in one}
    # day 1: rows a(s4) age 1 + null uid row -> 1/2
    assert by_day[_d(1)] == (0.5, None, None)
    # day 7: b is 7 days old, c is new -> 1/2 ; day 8: c age 1 -> 1/1
    assert by_day[_d(7)] == (None, 0.5, None)
    assert by_day[_d(8)] == (1.0, None, None)
    assert by_day[_d(30)] == (None, None, 1.0)
    assert _d(0) not in by_day and _d(3) not in by_day


def test_cohort_retention(spark):
    ud = _user_days(spark)
    got = {r.date: r for r in retention.cohort_retention(ud).collect()}
    assert got[_d(0)].cohort_size == 2  # a, b
    assert got[_d(0)].d1_retention == 0.5  # a back on day 1
    assert got[_d(0)].d7_retention == 0.5  # b back on day 7
    assert got[_d(0)].d30_retention == 0.5  # a back on day 30
    assert got[_d(7)].d1_retention == 1.0  # c
    # the data end on day 30: what lies behind it is unknown, not zero
    assert got[_d(7)].d7_retention == 0.0 and got[_d(7)].d30_retention is None


def test_dx_retention(spark):
    s = spark.createDataFrame([(_d(1), "a", _d(0)), (_d(1), "b", _d(1)), (_d(1), "c", _d(1)),
                               (_d(2), "a", _d(0))], "date date, combined_id string, earliest_date date")
    got = {r.date: r.dx_retention for r in retention.dx_retention(s, 1).collect()}
    assert got == {_d(1): 0.5, _d(2): None}


def test_funnel_ties_by_step(spark):
    pairs = spark.createDataFrame([("u1", "b"), ("u1", "a"), ("u2", "a"), ("u2", "b"), ("u3", "c"),
                                   ("u3", "a")], "uid string, url string")
    got = _rows(funnel.funnel_paths(pairs))
    # reach: a=3, b=2, c=1
    assert got == [("a>b", 2), ("a>c", 1)]
    reach = funnel.url_reach(pairs)
    assert [tuple(r) for r in funnel.top_steps(reach, 2).collect()] == [("a", 3), ("b", 2)]
    tie = spark.createDataFrame([("u1", "y"), ("u1", "x")], "uid string, url string")
    assert _rows(funnel.funnel_paths(tie)) == [("x>y", 1)]


def test_open_distribution(spark):
    rows = [("u1", "s", "https://h.example.com/homeWorkReport/1/"),
            ("u1", "s", "https://h.example.com/homeWorkReport/1/"),
            ("", "s2", "https://h.example.com/homeWorkReport/1/"),
            ("u1", "s", "https://h.example.com/homeWorkReport/2/"),
            ("u1", "s", "https://h.example.com/other/"), ("u1", "s", None)]
    df = spark.createDataFrame(rows, "uid string, _id string, url string")
    assert _rows(funnel.open_distribution(df)) == [(1, 2), (2, 1)]


PAY = ("purchase_number string, total_price bigint, pay_channel int, pay_date date, date date, "
       "line_no int, part_key bigint, supp_key bigint")


def test_revenue_latest_row_and_truncation(spark):
    rows = [("p1", 199, 2, _d(0), _d(0), 1, 1, 1), ("p1", 250, 43, None, _d(1), 1, 1, 1),
            ("p2", -199, 1, _d(1), _d(1), 1, 1, 1), ("p3", 101, 1, _d(1), _d(1), 2, 5, 1),
            ("p3", 999, 1, _d(1), _d(1), 1, 9, 9)]
    df = spark.createDataFrame(rows, PAY)
    got = _rows(commerce.revenue_by_channel(df, fx.PAYMENT_ORDER))
    assert got == [(_d(1), "支付宝二维码", 2, "p1"), (_d(1), "现金", 0, "p3")]
    first = {r.purchase_number: r.total_price for r in commerce.dedup_payments(df, fx.PAYMENT_ORDER).collect()}
    assert first == {"p1": 199, "p2": -199, "p3": 999}


def test_signup_explode_null_and_empty(spark):
    df = spark.createDataFrame([(1, ["x", "y"], _d(0)), (2, [], _d(0)), (3, None, _d(0)), (4, ["x"], _d(0))],
                               "purchase_id bigint, class_names array<string>, date date")
    assert _rows(commerce.signup_by_class(df)) == [(_d(0), "x", 2), (_d(0), "y", 1)]


def test_students_last_day(spark):
    df = spark.createDataFrame([(1, _d(0)), (1, _d(2)), (2, _d(2)), (3, _d(1))], "student_id bigint, date date")
    assert _rows(commerce.students_by_day(df)) == [(_d(1), 1), (_d(2), 2)]


def test_refund_by_status_skips_verify_success(spark):
    df = spark.createDataFrame([(1, "refund_apply", 199, 1000, 0, _d(0)),
                                (2, "refund_verify_success", 100, 100, 2, _d(0)),
                                (3, "refund_apply", 101, 500, 0, _d(0))],
                               "purchase_id bigint, action_type string, money bigint, purchase_money bigint, "
                               "status int, date date")
    assert _rows(commerce.refund_by_status(df)) == [(_d(0), "待审核", 2, 2, 15)]


def test_url_reach_approx(spark):
    from daypulse import fixtures as fx
    rows = fx.client_log(fx.table(spark, "/root/testdata/sf0.01", "events"))
    pairs = rows.select(F.col("uid"), F.col("event_type").alias("url"))
    exact = {r.url: r.reach for r in funnel.url_reach(pairs.filter("uid IS NOT NULL").distinct()).collect()}
    approx = {r.url: r.reach for r in funnel.url_reach(pairs, approx_rsd=0.02).collect()}
    assert set(exact) <= set(approx)
    for k, v in exact.items():
        assert abs(approx[k] - v) <= 0.1 * v


def _retention_brute(rows, days=(1, 7, 30)):
    first = {}
    for d, u, _ in rows:
        if u is not None:
            first[u] = min(first.get(u, d), d)
    out = {}
    for day in {d for d, _, _ in rows}:
        todays = [(u, s) for d, u, s in rows if d == day]
        ratios = []
        for n in days:
            back = sum(1 for u, _ in todays if u is not None and (day - first[u]).days == n)
            ratios.append(back / len(todays) if back else None)
        if any(r is not None for r in ratios):
            out[day] = tuple(ratios)
    return out


def test_retention_random(spark):
    import random
    rnd = random.Random(5)
    rows = sorted({(_d(rnd.randrange(40)), rnd.choice([None, "a", "b", "c", "d", "e"]), f"s{rnd.randrange(8)}")
                   for _ in range(120)}, key=str)
    df = spark.createDataFrame(rows, UD)
    one = {r[0]: tuple(r[1:]) for r in retention.retention(df).collect()}
    chain = {r["date"]: (r.d1_retention, r.d7_retention, r.d30_retention)
             for r in retention.retention_join_chain(df).collect()}
    assert one == chain == _retention_brute(rows)


def test_funnel_lists_keep_steps_apart(spark):
    """Steps that hold the separator: two lists, one text. Repeated pairs, a
    null user and null steps; reach counts users only."""
    pairs = [("a", "x>y"), ("a", "x>y"), ("b", "x"), ("b", "y"), ("c", "y"), (None, "z"), (None, "z"), ("d", None)]
    df = spark.createDataFrame(pairs, "uid string, url string")
    lists = sorted((tuple(r.funnel), r.cnt) for r in funnel.funnel_lists(df).collect())
    assert lists == [(("x>y",), 1), (("y",), 1), (("y", "x"), 1), (("z",), 1)]
    assert sorted(tuple(r) for r in funnel.funnel_paths(df).collect()) == [("x>y", 1), ("y", 1), ("y>x", 1), ("z", 1)]
    same = spark.createDataFrame([("a", "x>y"), ("b", "x"), ("b", "y"), ("c", "x")], "uid string, url string")
    assert sorted(tuple(r) for r in funnel.funnel_paths(same).collect()) == [("x", 1), ("x>y", 2)]
    assert funnel.funnel_lists(same).count() == 3


def test_funnel_equals_brute_force(spark):
    import random
    from collections import Counter
    r = random.Random(3)
    pairs = {(f"u{r.randrange(60)}", r.choice("abcdefg")) for _ in range(200)} | {("hot", c) for c in "abcdefgh"}
    reach = Counter(s for _, s in pairs)
    users = {}
    for u, s in pairs:
        users.setdefault(u, set()).add(s)
    expect = Counter(">".join(sorted(v, key=lambda s: (-reach[s], s))) for v in users.values())
    got = funnel.funnel_paths(spark.createDataFrame(sorted(pairs), "uid string, url string")).collect()
    assert {x.funnel: x.cnt for x in got} == dict(expect)
