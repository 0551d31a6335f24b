"""Streams in event time: dedup, sessions by silence, the join of two streams
and session states that end (T8, A16, J5, T3), against their batch forms."""

import datetime as dt
import os
import random

import pytest

from daypulse.operators import commerce, sessions
from daypulse.streaming import dedup, joins
from daypulse.streaming.sessions import current_sessions, start_gap_sessions, start_session_job

D0 = dt.datetime(2024, 1, 1)
ONCE = {"availableNow": True}


def at(hours):
    return D0 + dt.timedelta(hours=hours)


def ms(t):
    return int((t - dt.datetime(1970, 1, 1)).total_seconds() * 1000)


class Feed:
    """A folder of Parquet files, one micro-batch each, in the order written."""

    def __init__(self, spark, folder, ddl):
        self.spark, self.path, self.ddl, self.rows = spark, folder, ddl, []
        os.makedirs(folder)

    def add(self, *batches):
        for rows in batches:
            n = len(os.listdir(self.path))
            self.spark.createDataFrame(rows, self.ddl).coalesce(1).write.parquet(f"{self.path}/batch={n:03d}")
            self.rows += rows
        return self

    def stream(self):
        return (self.spark.readStream.schema(self.ddl).option("maxFilesPerTrigger", 1).option("latestFirst", False)
                .parquet(f"{self.path}/batch=*"))

    def batch(self):
        return self.spark.createDataFrame(self.rows, self.ddl)


def run(query):
    query.awaitTermination(180)
    assert query.exception() is None
    return query


def tuples(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


# --- A16 across micro-batches ----------------------------------------------
PAYMENT = "purchase_number string, pay_time timestamp, total_price long, pay_channel long, pay_date date, date date"
PAID = ["purchase_number", "total_price", "pay_channel", "date"]


def payment(number, hours, price=100):
    return (number, at(hours), price, 2, at(hours).date(), at(hours).date())


def test_dedup_across_batches_and_restart(spark, tmp_dir):
    feed = Feed(spark, f"{tmp_dir}/in", PAYMENT)
    target, checkpoint = f"{tmp_dir}/out", f"{tmp_dir}/ckpt"

    def go():
        return run(dedup.start_dedup_job(feed.stream(), target, checkpoint, ["purchase_number"], "pay_time", "24 hours", trigger=ONCE))

    feed.add([payment("a", 0), payment("b", 1)], [payment("c", 2)], [payment("a", 3, 999), payment("d", 4)])
    found = dedup.dropped(go())
    assert found == {"repeats": 1, "late": 0}  # a duplicate two batches later
    out = spark.read.parquet(target)
    assert tuples(out, *PAID) == tuples(commerce.dedup_payments(feed.batch()), *PAID)
    assert dedup.repeats(out, ["purchase_number"], "pay_time").collect() == []
    # the state lives in the checkpoint: a restart still knows the keys
    feed.add([payment("b", 10, 999), payment("e", 11), payment(None, 11)])
    assert dedup.dropped(go())["repeats"] == 1
    # far beyond the delay the key is forgotten: the repeat is landed and counted
    feed.add([payment("f", 100)], [payment("g", 101)], [payment("a", 102, 7)], [payment("h", 20)])
    assert dedup.dropped(go()) == {"repeats": 0, "late": 1}  # 'h' is behind the watermark
    out = spark.read.parquet(target)
    assert [(r.purchase_number, r.copies) for r in dedup.repeats(out, ["purchase_number"], "pay_time").collect()] == [("a", 2)]
    assert {r.purchase_number for r in out.collect()} == {"a", "b", "c", "d", "e", "f", "g", None}
    assert {r.total_price for r in out.where("purchase_number = 'b'").collect()} == {100}


def test_dedup_in_order_equals_batch(spark, tmp_dir):
    r = random.Random(3)
    feed = Feed(spark, f"{tmp_dir}/in", PAYMENT)
    for n in range(5):
        numbers = r.sample(range(30), 12)
        feed.add([payment(f"p{k}", 2 * n + i / 100, r.randrange(1000)) for i, k in enumerate(numbers)])
    run(dedup.start_dedup_job(feed.stream(), f"{tmp_dir}/out", f"{tmp_dir}/ckpt", ["purchase_number"], "pay_time", "20 hours", trigger=ONCE))
    want = commerce.dedup_payments(feed.batch(), order=("date", "pay_time"))
    assert tuples(spark.read.parquet(f"{tmp_dir}/out"), *PAID) == tuples(want, *PAID)


# --- T8: sessions by silence ------------------------------------------------
EVENT = "uid string, _id string, ts timestamp"


def islands(rows, gap_hours):
    by = {}
    for uid, sid, ts in rows:
        key = f"tmp_{sid}" if uid == "" else uid
        if key is not None and ts is not None:
            by.setdefault(key, []).append(ts)
    out = []
    for key, times in by.items():
        times.sort()
        start = last = times[0]
        n = 1
        for t in times[1:]:
            if (t - last).total_seconds() > gap_hours * 3600:
                out.append((key, ms(start), ms(last), n, ms(last) - ms(start)))
                start, n = t, 0
            last, n = t, n + 1
        out.append((key, ms(start), ms(last), n, ms(last) - ms(start)))
    return sorted(out, key=repr)


def test_sessions_by_gap_batch(spark):
    r = random.Random(5)
    rows = [(r.choice(["u1", "u2", "", None]), r.choice(["s1", "s2"]), at(r.randrange(0, 400) / 2)) for _ in range(150)]
    rows += [("u9", "s", at(0)), ("u9", "s", at(3)), ("u9", "s", at(6) + dt.timedelta(microseconds=1)), ("u9", "s", None)]
    got = sessions.sessions_by_gap(spark.createDataFrame(rows, EVENT), "3 hours")
    assert sorted(map(tuple, got.collect()), key=repr) == islands(rows, 3)
    assert sessions.sessions_by_gap(spark.createDataFrame([], EVENT)).collect() == []


def test_gap_stream_equals_batch_with_late_rows(spark, tmp_dir):
    feed = Feed(spark, f"{tmp_dir}/in", EVENT)
    feed.add([("u1", "s", at(0)), ("u2", "s", at(0.5)), ("", "x", at(1))], [("u1", "s", at(5)), ("u2", "s", at(3))],
             [("u1", "s", at(2.5))],  # late: bridges two sessions of u1
             [("u2", "s", at(20)), ("u1", "s", at(21))])
    target, checkpoint = f"{tmp_dir}/out", f"{tmp_dir}/ckpt"

    def go():
        return run(start_gap_sessions(feed.stream(), target, checkpoint, gap="3 hours", delay="6 hours", trigger=ONCE))

    go()
    columns = ["combined_id", "start_t", "end_t", "events", "session_length"]
    first = tuples(spark.read.parquet(target), *columns)
    assert ("u1", ms(at(0)), ms(at(5)), 3, ms(at(5)) - ms(at(0))) in first and len(first) == 3  # the open ones are not out yet
    feed.add([("end", "s", at(100))], [("end", "s", at(200))])
    go()  # after a restart, and past the watermark, the open ones leave, each once
    got = [t for t in tuples(spark.read.parquet(target), *columns) if t[0] != "end"]
    assert got == [t for t in islands(feed.rows, 3) if t[0] != "end"]


# --- J5 as a join of streams ------------------------------------------------
POINT = "event_time timestamp, date date, combined_id string, session_length long, session_count long"
FIRST = "first_time timestamp, combined_id string"
AGED = ["date", "combined_id", "earliest_date", "session_length", "session_count"]


def point(user, day, length=1):
    t = D0 + dt.timedelta(days=day)
    return (t, t.date(), user, length, 1)


def test_stream_join_equals_batch_and_unmatched_leave_once(spark, tmp_dir):
    points, firsts = Feed(spark, f"{tmp_dir}/p", POINT), Feed(spark, f"{tmp_dir}/f", FIRST)
    days = {"u1": [0, 2, 5], "u2": [1, 2], "u3": [4, 6], "lost": [3]}

    def files(lo, hi):
        points.add([point(u, d, d + 1) for u, own in days.items() for d in own if lo <= d < hi])
        firsts.add([(D0 + dt.timedelta(days=own[0]), u) for u, own in days.items() if lo <= own[0] < hi and u != "lost"])

    def go():
        return run(joins.start_age_job(points.stream(), firsts.stream(), f"{tmp_dir}/out", f"{tmp_dir}/ckpt", delay="1 day",
                                       horizon="30 days", trigger=ONCE))

    files(0, 3)
    files(3, 5)
    go()
    early = spark.read.parquet(f"{tmp_dir}/out")
    assert early.where("combined_id = 'lost'").count() == 0  # a first day may still come
    files(5, 7)
    points.add([point("end", 60)])
    firsts.add([(D0 + dt.timedelta(days=60), "end")])
    go()
    points.add([point("end", 90)])
    firsts.add([(D0 + dt.timedelta(days=90), "end")])
    go()
    out = spark.read.parquet(f"{tmp_dir}/out").where("combined_id <> 'end'")
    lost = out.where("combined_id = 'lost'").collect()
    assert [r.earliest_date for r in lost] == [None]  # left after the delay, once
    want = sessions.sessions_with_age(points.batch().where("combined_id NOT IN ('end', 'lost')").drop("event_time"))
    assert tuples(out.where("combined_id <> 'lost'"), *AGED) == tuples(want, *AGED)


def test_first_seen_stream(spark, tmp_dir):
    feed = Feed(spark, f"{tmp_dir}/in", POINT).add([point("a", 0), point("b", 1)], [point("a", 2), point("c", 2)])
    query = joins.first_seen(feed.stream(), "10 days").writeStream.format("memory").queryName("firsts").outputMode("append")
    run(query.option("checkpointLocation", f"{tmp_dir}/ckpt").trigger(**ONCE).start())
    assert tuples(spark.table("firsts"), "combined_id", "first_time") == [
        ("a", D0), ("b", D0 + dt.timedelta(days=1)), ("c", D0 + dt.timedelta(days=2))]


# --- T3 with an end ----------------------------------------------------------
CLIENT = "t long, uid string, _id string, date date"


def client(hours, uid, sid):
    return (ms(at(hours)), uid, sid, at(hours).date())


def test_expiring_state_stays_flat_and_equals_rollup(spark, tmp_dir):
    """1,000 sessions, closed one after the other; some cross midnight, come
    back after their state has ended, or get their name late."""
    feed = Feed(spark, f"{tmp_dir}/in", CLIENT)
    for day in range(10):
        rows = [client(24 * day + k / 20, "" if k % 3 else f"u{k % 7}", f"s{100 * day + k}") for k in range(100)]
        rows += [client(24 * day + 23.5, "u1", f"s{100 * day + 99}"), client(24 * day + 24.2, "", f"s{100 * day + 99}")]
        if day == 8:
            rows.append(client(24 * day + 12, "late", "s5"))
        feed.add(rows)
    query = run(start_session_job(feed.stream(), f"{tmp_dir}/log", f"{tmp_dir}/ckpt", trigger=ONCE, state="expiring", window="1 day",
                                  delay="12 hours"))
    sizes = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert len(sizes) >= 10 and max(sizes) <= 320  # three days of sessions at most, however many have closed
    assert sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators) == 0
    columns = ["_id", "uid", "date", "start_t", "end_t"]
    assert tuples(current_sessions(spark, f"{tmp_dir}/log"), *columns) == tuples(sessions.session_rollup(feed.batch()), *columns)
    growing = run(start_session_job(feed.stream(), f"{tmp_dir}/log2", f"{tmp_dir}/ckpt2", trigger=ONCE, state="store"))
    assert max(p.stateOperators[0].numRowsTotal for p in growing.recentProgress if p.stateOperators) >= 1000
    assert tuples(current_sessions(spark, f"{tmp_dir}/log2"), *columns) == tuples(sessions.session_rollup(feed.batch()), *columns)


def test_unknown_state_is_refused(spark, tmp_dir):
    with pytest.raises(ValueError):
        start_session_job(spark.createDataFrame([], CLIENT), f"{tmp_dir}/l", f"{tmp_dir}/c", state="none")

