"""A2 / B1 window lengths, null uid rules, explode == interval == brute force."""

import datetime as dt
import random
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from daypulse.operators import activity

D0 = dt.date(2024, 1, 1)
SCHEMA = "date date, uid string, _id string, app_id bigint, is_wechat boolean"
DIMS = ["app_id", "is_wechat"]


def _day(n):
    return D0 + dt.timedelta(days=n)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_window_lengths_one_user(spark):
    df = spark.createDataFrame([(_day(0), "u1", "s1", 1, False)], SCHEMA)
    out = {r["date"]: r for r in activity.active_users_interval(df, DIMS).collect()}
    assert len(out) == 31
    for k in range(31):
        r = out[_day(k)]
        assert r.dau == (1 if k == 0 else 0)
        assert r.wau == (1 if k <= 7 else 0)
        assert r.mau == 1
        assert r.sessions == (1 if k == 0 else 0)


def test_null_and_empty_uid(spark):
    rows = [(_day(0), None, "s1", 1, False), (_day(0), "", "s1", 1, False), (_day(0), "u1", "s1", 1, False)]
    df = spark.createDataFrame(rows, SCHEMA)
    r = [x for x in activity.active_users_interval(df, DIMS).collect() if x["date"] == _day(0)][0]
    assert (r.dau, r.sessions) == (2, 1)
    only_null = spark.createDataFrame([(_day(0), None, "s9", 2, True)], SCHEMA)
    out = activity.active_users_interval(only_null, DIMS).collect()
    assert len(out) == 31 and all(x.dau == 0 and x.mau == 0 for x in out)


def brute_force(rows):
    """Python definition of A2: copies to +0..30, distinct counts."""
    acc = defaultdict(lambda: [set(), set(), set(), set()])
    for date, uid, sid, app, wechat in rows:
        for off in range(31):
            key = (date + dt.timedelta(days=off), app, wechat)
            a = acc[key]
            if off == 0 and sid is not None:
                a[0].add(sid)
            if uid is not None:
                if off < 1:
                    a[1].add(uid)
                if off < 8:
                    a[2].add(uid)
                a[3].add(uid)
    return sorted((k[0], k[1], k[2], len(v[0]), len(v[1]), len(v[2]), len(v[3])) for k, v in acc.items())


row_st = st.tuples(st.integers(0, 45), st.sampled_from([None, "", "u1", "u2", "u3"]),
                   st.sampled_from(["s1", "s2", "s3"]), st.integers(0, 1), st.booleans())


@settings(max_examples=6, deadline=None)
@given(st.lists(row_st, min_size=1, max_size=25))
def test_interval_equals_explode_and_brute_force(spark, raw):
    # user-day rows are unique per (date, uid, _id): keep the first of each
    seen, rows = set(), []
    for d, u, s, a, w in raw:
        if (d, u, s) not in seen:
            seen.add((d, u, s))
            rows.append((_day(d), u, s, a, w))
    df = spark.createDataFrame(rows, SCHEMA)
    interval = _rows(activity.active_users_interval(df, DIMS))
    explode = _rows(activity.active_users_explode(df, DIMS).select(
        "date", *DIMS, "sessions", "dau", "wau", "mau"))
    assert interval == explode == brute_force(rows)


def test_explode_with_repeats_and_nulls(spark):
    rnd = random.Random(11)
    rows = [(_day(rnd.randrange(80)), rnd.choice([None, "", "u1", "u2", "u3"]), rnd.choice([None, "s1", "s2", "s3", "u1"]),
             rnd.choice([None, 1, 2]), rnd.choice([None, True, False])) for _ in range(90)]
    rows += rows[:30]
    got = activity.active_users_explode(spark.createDataFrame(rows, SCHEMA), DIMS)
    key = lambda r: [(v is not None, v) for v in r]
    assert sorted(map(tuple, got.collect()), key=key) == [*_sorted_brute_force(rows, key)]


def _sorted_brute_force(rows, key):
    found = []
    for app, wechat in {r[3:] for r in rows}:
        own = [(*r[:3], 0, False) for r in rows if r[3:] == (app, wechat)]
        found += [(r[0], app, wechat, *r[3:]) for r in brute_force(own)]
    return sorted(found, key=key)


def test_explode_counts_days_without_a_date_once(spark):
    rows = [(None, "u1", "s1", 1, False), (None, "u1", "s2", 1, False), (None, "u2", "s2", 1, False),
            (None, None, "s3", 2, True), (_day(0), "u1", "s1", 1, False)]
    got = activity.active_users_explode(spark.createDataFrame(rows, SCHEMA), DIMS).where("date is null")
    assert sorted(map(tuple, got.collect())) == [(None, 1, False, 2, 2, 2, 2), (None, 2, True, 1, 0, 0, 0)]


def test_trailing_active_x7(spark):
    df = spark.createDataFrame([("a", _day(0)), ("b", _day(2)), ("a", _day(12))],
                               "combined_id string, date date")
    got = {r.date: r.xau for r in activity.trailing_active(df, "combined_id", 7).collect()}
    assert sorted(got) == [_day(k) for k in range(13)]
    expect = {0: 1, 1: 1, 2: 2, 6: 2, 7: 1, 8: 1, 9: 0, 11: 0, 12: 1}
    for k, v in expect.items():
        assert got[_day(k)] == v, k


def test_trailing_active_random(spark):
    rnd = random.Random(7)
    pairs = {(f"u{rnd.randrange(6)}", _day(rnd.randrange(40))) for _ in range(60)}
    df = spark.createDataFrame(sorted(pairs), "combined_id string, date date")
    for x in (1, 7, 30):
        got = {r.date: r.xau for r in activity.trailing_active(df, "combined_id", x).collect()}
        lo, hi = min(d for _, d in pairs), max(d for _, d in pairs)
        day = lo
        while day <= hi:
            want = len({u for u, d in pairs if day - dt.timedelta(days=x - 1) <= d <= day})
            assert got[day] == want
            day += dt.timedelta(days=1)


def test_dense_calendar_fills_gaps(spark):
    df = spark.createDataFrame([(_day(0), 3), (_day(3), 1)], "date date, n bigint")
    got = _rows(activity.dense_calendar(df, ["n"]))
    assert got == [(_day(0), 3), (_day(1), 0), (_day(2), 0), (_day(3), 1)]


def test_high_water_mark(spark):
    df = spark.createDataFrame([(_day(0),), (_day(5),)], "date date")
    assert activity.high_water_mark(df).collect()[0][0] == _day(4)
    assert activity.since_mark(df, "2024-01-31").count() == 1


def test_dims_summed_equals_sum_of_table(spark):
    from daypulse.operators import bi
    rnd = random.Random(3)
    rows, seen = [], set()
    for _ in range(40):
        key = (rnd.randrange(40), rnd.choice([None, "", "u1", "u2", "u3", "u4"]), f"s{rnd.randrange(5)}")
        if key not in seen:
            seen.add(key)
            rows.append((_day(key[0]), key[1], key[2], rnd.randrange(2), rnd.random() < 0.5))
    df = spark.createDataFrame(rows, SCHEMA)
    summed = _rows(activity.active_users_dims_summed(df, DIMS))
    via_table = _rows(bi.basics_per_day(activity.active_users_interval(df, DIMS))
                      .select("date", "sessions", "dau", "wau", "mau"))
    assert summed == via_table
