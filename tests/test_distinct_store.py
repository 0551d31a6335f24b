"""Stored bitmaps and sketches of users against counts over the rows."""

import datetime as dt
import random

from pyspark.sql import functions as F

from daypulse.operators import distinct_store as ds
from daypulse.sinks.tables import write_table

D0 = dt.date(2024, 1, 1)
DIMS = ["app_id", "os", "is_wechat"]
ROWS = "date date, uid string, app_id long, os string, is_wechat boolean"


def some_rows(seed, n=600, users=90, days=45):
    r = random.Random(seed)
    return [(D0 + dt.timedelta(days=r.randrange(days)), r.choice([None, "", *[f"u{k}" for k in range(users)]]), r.choice([1, 2, None]),
             r.choice(["iOS", "Android"]), r.choice([True, False, None])) for _ in range(n)]


def text(v):
    return "null" if v is None else str(v).lower() if isinstance(v, bool) else str(v)


def brute(rows, windows):
    users = {}
    for date, uid, *dims in rows:
        values = [text(v) for v in dims]
        for key in [("total", ""), ("all", "|".join(values)), *zip(DIMS, values)]:
            users.setdefault(key, {}).setdefault(date, set()).update([uid] if uid is not None else [])
    out = set()
    for key, days in users.items():
        for day in {d + dt.timedelta(days=k) for d in days for k in range(max(windows))}:
            out.add((day, *key, *(len(set().union(*(days.get(day - dt.timedelta(days=k), set()) for k in range(n)))) for n in windows)))
    return out


def test_numbers_are_dense_and_stay(spark):
    rows = spark.createDataFrame(some_rows(1), ROWS)
    first = ds.number_users(rows, ranges=7)
    got = {r.uid: r.n for r in first.collect()}
    assert sorted(got.values()) == list(range(len(got))) and None not in got and "" in got
    more = rows.select("uid").unionByName(spark.createDataFrame([("new",), ("newer",), ("new",), (None,)], "uid string"))
    later = {r.uid: r.n for r in ds.number_users(more, first, ranges=7).collect()}
    assert {u: later[u] for u in got} == got and sorted(later.values()) == list(range(len(got) + 2))
    assert ds.number_users(rows.limit(0)).collect() == []
    assert [r.n for r in ds.number_users(rows.limit(1).withColumn("uid", F.lit("a")), first.limit(0)).collect()] == [0]


def test_actives_equal_counts_over_rows(spark):
    data = some_rows(2)
    rows = spark.createDataFrame(data, ROWS)
    bits = ds.day_bitmaps(rows, ds.number_users(rows), DIMS)
    got = {tuple(r) for r in ds.actives(bits).collect()}
    assert got == brute(data, (1, 8, 31))
    got = {tuple(r) for r in ds.actives(bits, {"two": 2, "five": 5}).collect()}
    assert got == brute(data, (2, 5))
    assert ds.actives(bits.limit(0)).collect() == []


def test_users_over_several_buckets(spark):
    rows = spark.range(70_000).select(F.lit(D0).alias("date"), F.col("id").cast("string").alias("uid"), (F.col("id") % 2).alias("app_id"),
                                      F.lit("x").alias("os"), F.lit(True).alias("is_wechat"))
    bits = ds.day_bitmaps(rows, ds.number_users(rows), DIMS)
    assert bits.where("dim = 'total'").count() == 3  # buckets of 32,768
    got = {(r.dim, r.value): r.dau for r in ds.actives(bits).where(F.col("date") == F.lit(D0)).collect()}
    assert got[("total", "")] == 70_000 and got[("app_id", "0")] == got[("app_id", "1")] == 35_000


def test_days_are_written_once_and_rows_not_read_again(spark, tmp_dir):
    """Each day's bitmaps are stored as the day closes; windows read them only."""
    data = some_rows(3, n=400, days=12)
    store, numbers_at = f"{tmp_dir}/bits", f"{tmp_dir}/numbers"
    for k in range(12):
        day = spark.createDataFrame([r for r in data if r[0] == D0 + dt.timedelta(days=k)], ROWS)
        known = spark.read.parquet(numbers_at) if k else None
        numbers = ds.number_users(day, known)
        fresh = numbers if known is None else numbers.join(known, "uid", "left_anti")
        fresh.write.mode("append").parquet(numbers_at)
        write_table(ds.day_bitmaps(day, spark.read.parquet(numbers_at), DIMS), store, partition_by="date", mode="overwrite")
    found = ds.actives(spark.read.parquet(store))
    assert {tuple(r) for r in found.collect()} == brute(data, (1, 8, 31))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert store in plan and "uid" not in plan and numbers_at not in plan
    assert "distinct" not in plan.lower()
    size = sum(len(r.bits) for r in spark.read.parquet(store).collect())
    assert size == 4096 * spark.read.parquet(store).count()


def test_sketches_of_days_merge_within_their_bound(spark, tmp_dir):
    rows = spark.range(120_000).select(
        F.date_add(F.lit(D0), (F.col("id") % 10).cast("int")).alias("date"), F.concat(F.lit("u"), (F.col("id") * 7919 % 40_000).cast("string")).alias("uid"),
        F.concat(F.lit("s"), F.col("id") % 3).alias("step")).unionByName(
        spark.createDataFrame([(D0, None, "s0"), (D0, "u1", None), (D0, "u1", "rare")], "date date, uid string, step string"))
    ds.day_sketches(rows, "step").write.parquet(f"{tmp_dir}/sketches")
    stored = spark.read.parquet(f"{tmp_dir}/sketches")
    assert stored.count() == 31
    for first, last in ((None, None), ("2024-01-03", "2024-01-05"), ("2024-01-02", None)):
        own = rows.where(F.col("step").isNotNull() & (F.col("date") >= F.lit(first or "2000-01-01").cast("date"))
                         & (F.col("date") <= F.lit(last or "2100-01-01").cast("date")))
        exact = {r.step: r.n for r in own.groupBy("step").agg(F.count_distinct("uid").alias("n")).collect()}
        got = {r.step: r.users for r in ds.reach(stored, first, last).collect()}
        assert got.keys() == exact.keys()
        for step, n in exact.items():
            assert abs(got[step] - n) <= max(1, ds.error_bound() * n), (step, n, got[step])
    assert ds.reach(stored, "2030-01-01").collect() == []
