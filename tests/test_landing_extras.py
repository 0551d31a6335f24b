"""Fields outside the schema, bucketed tables, and daily numbers per batch."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from daypulse import schemas
from daypulse.operators import activity, extra_fields, retention, sessions
from daypulse.sinks.tables import write_bucketed
from daypulse.sources.streams import read_log_stream
from daypulse.streaming import ingest, metrics

T0 = 1704067200000  # 2024-01-01


def client(hours, sid="s", uid="u", **more):
    return json.dumps({"t": T0 + hours * 3_600_000, "_id": sid, "uid": uid, "appId": 1, "url": "u", **more})


def land(spark, folder, targets, name, lines):
    os.makedirs(f"{folder}/in", exist_ok=True)
    os.makedirs(f"{folder}/none", exist_ok=True)
    with open(f"{folder}/in/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")
    for q in ingest.start_ingest(read_log_stream(spark, "text", path=f"{folder}/in"), read_log_stream(spark, "text", path=f"{folder}/none"),
                                 targets, f"{folder}/ckpt", trigger={"availableNow": True}):
        q.awaitTermination(120)
        assert q.exception() is None


def test_unknown_fields_survive_the_landing(spark, tmp_dir):
    targets = ingest.IngestTargets(*[f"{tmp_dir}/{n}" for n in ("client", "pay", "ref", "stu", "sig")], keep_extra=True)
    land(spark, tmp_dir, targets, "a.txt", [client(0), client(1, ab={"group": "x", "seed": 7}), "no json"])
    land(spark, tmp_dir, targets, "b.txt", [client(2, ab={"group": "y"}, flags=[1, 2]), client(3, flags=["z"]), client(4, u_a="known")])
    rows = spark.read.parquet(targets.client)
    assert rows.count() == 5 and rows.where("_extra IS NULL").count() == 2  # known traffic carries nothing
    known = schemas.CLIENT_LOG.names
    found = {r.field: (r.rows, r.type) for r in extra_fields.report(rows, known).collect()}
    assert found == {"ab": (2, "OBJECT<group: STRING, seed: BIGINT>"), "flags": (2, "ARRAY<VARIANT>")}
    # read later from the landed rows; the topic is not read again
    got = extra_fields.with_fields(rows, {"ab.group": "string", "ab.seed": "bigint", "flags[1]": "int"})
    assert sorted((r.t - T0) // 3_600_000 for r in got.where("`ab.group` = 'y'").collect()) == [2]
    assert {r["ab.seed"] for r in got.collect()} == {None, 7} and {r["flags[1]"] for r in got.collect()} == {None, 2}
    assert extra_fields.with_field(rows, "ab.group", "bigint", "n").where("n IS NOT NULL").count() == 0  # another type: null
    plan = extra_fields.with_field(rows, "ab.group", "string", "g").select("g")._jdf.queryExecution().executedPlan().toString()
    assert targets.client in plan and "Python" not in plan


def test_extra_of_odd_values(spark):
    rows = spark.createDataFrame([(v,) for v in ('{"k": 1}', '{"k": 1, "n": null}', "[1]", "3", "", None, '{"k": ', '{"K": 1}')], "props string")
    got = rows.select("props", extra_fields.extra("props", ["k"]).alias("_extra"))
    assert {r.props for r in got.where("_extra IS NOT NULL").collect()} == {'{"k": 1, "n": null}', '{"K": 1}'}
    assert {(r.field, r.rows) for r in extra_fields.report(got, ["k"]).collect()} == {("n", 1), ("K", 1)}
    assert extra_fields.report(got.limit(0), ["k"]).collect() == []


def test_bucketed_tables_need_no_shuffle_by_user(spark):
    days = spark.range(5_000).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("date"),
                                     F.when(F.col("id") % 50 > 0, F.concat(F.lit("u"), F.col("id") % 300)).alias("uid"),
                                     F.concat(F.lit("s"), F.col("id")).alias("_id"))
    write_bucketed(days, "user_days_by_uid", "uid", 16)
    stored = spark.table("user_days_by_uid")
    key, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    spark.conf.set(key, "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        for made in (retention.user_age, activity.first_visit):
            plan = made(stored)._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "Bucketed: true" in plan
            assert "Exchange" in made(days)._jdf.queryExecution().executedPlan().toString()
            assert sorted(map(tuple, made(stored).collect())) == sorted(map(tuple, made(days).collect()))
        ratio = retention.retention(stored)
        assert ratio._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(uid") == 0
    finally:
        spark.conf.set(key, before)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold") if adaptive is None else spark.conf.set(
            "spark.sql.adaptive.autoBroadcastJoinThreshold", adaptive)
        spark.sql("DROP TABLE user_days_by_uid")


def test_daily_numbers_follow_each_batch(spark, tmp_dir):
    src, log = f"{tmp_dir}/in", f"{tmp_dir}/log"
    os.makedirs(src)
    out = metrics.MetricTables(*[f"{tmp_dir}/{n}" for n in ("new", "active", "returning", "day")])
    lines = []

    def go(name, more):
        lines.extend(more)
        with open(f"{src}/{name}", "w") as f:
            f.write("\n".join(more) + "\n")
        q = metrics.start_metrics_job(ingest.client_rows(read_log_stream(spark, "text", path=src)), log, out, f"{tmp_dir}/ckpt",
                                      trigger={"availableNow": True})
        q.awaitTermination(180)
        assert q.exception() is None
        snapshot = sessions.sessions_table(ingest.client_rows(spark.createDataFrame([(x,) for x in lines], "value string")))
        for table, want in metrics.daily_metrics(snapshot).items():
            got = spark.read.parquet(getattr(out, table)).select(*want.columns)
            assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr), table

    go("a.txt", [client(0, "s1", "a"), client(2, "s1", "a"), client(3, "s2", ""), client(26, "s3", "a")])
    go("b.txt", [client(4, "s2", "b"), client(50, "s4", "b")])  # the visitor of s2 has a name now
    go("c.txt", [client(-20, "s5", "a")])  # late: user a is older than thought
    go("d.txt", [client(5, "s4", "b")])  # s4 began two days earlier: its old day has no session left
    assert spark.read.parquet(out.new_users).where("date = '2024-01-03'").count() == 0
    assert metrics.refresh(spark, log, out) == {"new_users": 0, "active": 0, "returning": 0, "per_day": 0}  # nothing to replace
    days = {r.date: r.new_users for r in spark.read.parquet(out.new_users).collect()}
    assert days[dt.date(2023, 12, 31)] == 1 and days[dt.date(2024, 1, 1)] == 1
