"""Streams (T1-T7, K7, K9) against the batch definitions, and sinks (K1-K8,
S8-S10), with a text-file source and ``availableNow`` triggers."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from daypulse import schemas
from daypulse.operators import sessions
from daypulse.sinks.tables import path_exists, read_table, to_json_rows, write_and_check, write_table
from daypulse.sources.streams import read_log_stream
from daypulse.sources.tables import empty_table, load_or_build_geo, scan
from daypulse.streaming import ingest
from daypulse.streaming.sessions import compact, current_sessions, session_states, sessions_snapshot, start_session_job

D0 = dt.datetime(2024, 1, 1)


def _ms(d):
    return int((d - dt.datetime(1970, 1, 1)).total_seconds() * 1000)


def _client_line(t_ms, uid, sid, **extra):
    rec = {"t": t_ms, "_id": sid, "appId": 1, "url": "https://h.example.com/a/", **extra}
    if uid is not None:
        rec["uid"] = uid
    return json.dumps(rec)


def _write_lines(folder, name, lines):
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def _run(q):
    q.awaitTermination(120)
    assert q.exception() is None


def _session_stream(spark, src, log, ckpt, **options):
    lines = read_log_stream(spark, "text", path=src, **options)
    _run(start_session_job(ingest.client_rows(lines), log, ckpt, trigger={"availableNow": True}))


def _assert_snapshot(spark, logs, lines):
    """The tables derived from the log equal the batch definition of all lines."""
    rows = ingest.client_rows(spark.createDataFrame([(x,) for x in lines], "value string"))
    for got, expect in ((sessions_snapshot(spark, *logs), sessions.sessions_table(rows)),
                        (current_sessions(spark, *logs), sessions.session_rollup(rows))):
        assert set(got.columns) == set(expect.columns)
        assert sorted(map(tuple, got.select(*expect.columns).collect())) == sorted(map(tuple, expect.collect()))


def test_session_stream_equals_batch_across_restart(spark, tmp_dir):
    src, log, ckpt = (os.path.join(tmp_dir, n) for n in ("in", "log", "ckpt"))
    os.makedirs(src)
    batch1 = [_client_line(_ms(D0), "", "s1"), _client_line(_ms(D0) + 60, "", "s1"),
              _client_line(_ms(D0) + 5, "u9", "s2"), _client_line(_ms(D0) + 7, None, "s3")]
    batch2 = [_client_line(_ms(D0) + 120, "u1", "s1"),  # late uid, same session
              _client_line(_ms(D0 + dt.timedelta(days=1)), "u9", "s4")]
    batch3 = [_client_line(_ms(D0 + dt.timedelta(days=2)), "u1", "s5"), "not json"]
    _write_lines(src, "a.txt", batch1)
    _session_stream(spark, src, log, ckpt)
    assert [r.combined_id for r in sessions_snapshot(spark, log).collect() if r.combined_id != "u9"] == ["tmp_s1"]
    _write_lines(src, "b.txt", batch2)
    _session_stream(spark, src, log, ckpt)
    # the session touched in two batches counts once, with its full length, under its late name
    dps = {(r.combined_id, r.date): r for r in sessions_snapshot(spark, log).collect()}
    assert (dps[("u1", D0.date())].session_length, dps[("u1", D0.date())].session_count) == (120, 1)
    _write_lines(src, "c.txt", batch3)
    _session_stream(spark, src, log, ckpt)  # restart on the same checkpoint: only the new file is read
    _assert_snapshot(spark, [log], batch1 + batch2 + batch3)
    # a second checkpoint reads all lines again, as a run of its own: nothing counts twice
    _session_stream(spark, src, log, os.path.join(tmp_dir, "again"), max_per_trigger=1)
    assert spark.read.parquet(log).select("_run_id").distinct().count() == 2
    _assert_snapshot(spark, [log], batch1 + batch2 + batch3)
    folded = os.path.join(tmp_dir, "folded")
    compact(spark, folded, log)
    assert spark.read.parquet(folded).count() == 4
    _assert_snapshot(spark, [folded], batch1 + batch2 + batch3)
    _assert_snapshot(spark, [folded, log], batch1 + batch2 + batch3)
    with pytest.raises(ValueError):
        compact(spark, log, log)


def test_session_batches_touch_only_their_own_rows(spark, tmp_dir):
    src, log, ckpt = (os.path.join(tmp_dir, n) for n in ("in", "log", "ckpt"))
    os.makedirs(src)
    late = D0 + dt.timedelta(days=400)
    batch1 = [_client_line(_ms(D0), "u1", "s1")] + [_client_line(_ms(D0) + i, f"u{i}", f"x{i}") for i in range(2, 40)]
    batch2 = [_client_line(_ms(late), "u1", "s1"), _client_line(_ms(late) + 1, "u1", "s9")]

    def files():
        return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
                for d, _, names in os.walk(log) for f in names if f.endswith(".parquet")}

    _write_lines(src, "a.txt", batch1)
    _session_stream(spark, src, log, ckpt)
    before = files()
    _write_lines(src, "b.txt", batch2)
    _session_stream(spark, src, log, ckpt)
    after = files()
    assert {f: t for f, t in after.items() if f in before} == before
    assert spark.read.parquet(log).where("_batch_id = 1").count() == 2
    _assert_snapshot(spark, [log], batch1 + batch2)
    # a replay of batch 1 rewrites its own partition only
    run = spark.read.parquet(log).first()._run_id
    rows = ingest.client_rows(spark.createDataFrame([(x,) for x in batch2], "value string"))
    ingest.write_batch(session_states(rows), 1, log, run_id=run, partition_by=())
    assert spark.read.parquet(log).count() == 41
    _assert_snapshot(spark, [log], batch1 + batch2)


def test_ingest_fan_out(spark, tmp_dir):
    csrc, ssrc = os.path.join(tmp_dir, "c"), os.path.join(tmp_dir, "s")
    os.makedirs(csrc)
    os.makedirs(ssrc)
    _write_lines(csrc, "1.txt", [_client_line(_ms(D0), "u1", "s1"), '{"uid": "no-t"}'])
    body = '2024-01-02 00:00:00.000 {"actionType":"%s","purchaseNumber":"p1","totalPrice":100}'
    _write_lines(ssrc, "1.txt", [body % a for a in ("pay", "refund_apply", "refund_verify_success",
                                                     "student_add", "signup_class")] + ["too short"])
    targets = ingest.IngestTargets(*[os.path.join(tmp_dir, "t", n) for n in
                                     ("client", "payment", "refund", "student", "signup")])
    qs = ingest.start_ingest(read_log_stream(spark, "text", path=csrc),
                             read_log_stream(spark, "text", path=ssrc), targets,
                             os.path.join(tmp_dir, "ckpt"), trigger={"availableNow": True})
    for q in qs:
        _run(q)
    assert spark.read.parquet(targets.client).count() == 1  # the row without t is dropped
    counts = {n: spark.read.parquet(p).count() for n, p in targets.server_routes().items()}
    assert counts == {"payment": 1, "refund": 1, "student": 1, "signup": 1}
    pay = spark.read.parquet(targets.payment).collect()[0]
    assert (pay.date, pay.purchaseNumber, pay._batch_id) == (dt.date(2024, 1, 2), "p1", 0)
    # replaying batch 0 of the run rewrites the same partitions: no duplicates
    batch = ingest.server_rows(spark.read.text(ssrc))
    ingest.fan_out(batch, 0, targets.server_routes(), run_id=pay._run_id)
    assert spark.read.parquet(targets.payment).count() == 1
    # batch 0 of another run (a new checkpoint) adds rows and removes none
    ingest.fan_out(batch, 0, targets.server_routes(), run_id="other")
    assert spark.read.parquet(targets.payment).count() == 2


def test_poison_rows_are_quarantined_and_new_checkpoint_adds(spark, tmp_dir):
    csrc, ssrc = os.path.join(tmp_dir, "c"), os.path.join(tmp_dir, "s")
    os.makedirs(csrc)
    os.makedirs(ssrc)
    _write_lines(csrc, "1.txt", [_client_line(_ms(D0), "u1", "s1"), _client_line(9223372036854775807, "u1", "s2"),
                                 _client_line(-5, "u1", "s3"), "not json", '{"uid": "no-t"}'])
    _write_lines(ssrc, "1.txt", ["too short", '2024-01-02 00:00:00.000 {"actionType":"pay","purchaseNumber":"p1"}',
                                 "2024-01-02 00:00:00.000 not json at all", '2024-01-02 00:00:00.000 {"actionType":"other"}'])
    spark.sql("DROP TABLE IF EXISTS landed_client")
    targets = ingest.IngestTargets(*[os.path.join(tmp_dir, "t", n) for n in
                                     ("client", "payment", "refund", "student", "signup", "quarantine")], "landed_client")
    for ckpt in ("ckpt", "again"):
        for q in ingest.start_ingest(read_log_stream(spark, "text", path=csrc), read_log_stream(spark, "text", path=ssrc),
                                     targets, os.path.join(tmp_dir, ckpt), trigger={"availableNow": True}):
            _run(q)
    reasons = sorted(tuple(r) for r in spark.read.parquet(targets.quarantine).groupBy("stream", "reason").count().collect())
    assert reasons == [("client", "bad time", 4), ("client", "missing field", 2), ("client", "not json", 2),
                       ("server", "no action", 2), ("server", "short line", 2)]
    # two checkpoints, two runs of one good row each, in the files and in the table (K9)
    assert spark.read.parquet(targets.client).count() == spark.table("landed_client").count() == 2
    assert spark.read.parquet(targets.payment).count() == 2
    spark.sql("DROP TABLE landed_client")


def test_catalog_overwrite_keeps_other_days(spark):
    df = spark.createDataFrame([(1, "a", dt.date(2024, 1, 1)), (2, "b", dt.date(2024, 1, 2))], "v int, k string, date date")
    spark.sql("DROP TABLE IF EXISTS two_days")
    write_table(df.filter("v = 1"), "two_days", "date", "overwrite")
    write_table(df.filter("v = 2").select("date", "v", "k"), "two_days", "date", "overwrite")
    write_table(df.filter("v = 2").withColumn("k", F.lit("c")), "two_days", "date", "overwrite")
    assert sorted((r.v, r.k) for r in spark.table("two_days").collect()) == [(1, "a"), (2, "c")]
    spark.sql("DROP TABLE two_days")


def test_sinks_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), "a", 1), (dt.date(2024, 1, 2), "b", 2)],
                               "date date, k string, v int")
    target = os.path.join(tmp_dir, "t")
    assert not path_exists(spark, target)
    assert write_and_check(df, target, partition_by="date", mode="overwrite", expected_rows=2) == 2
    assert {"date=2024-01-01", "date=2024-01-02"} <= set(os.listdir(target))
    # overwrite of one day keeps the other (dynamic partition overwrite)
    write_table(df.filter(F.col("k") == "a").withColumn("v", F.lit(9)), target, "date", "overwrite")
    got = sorted(tuple(r) for r in read_table(spark, target).select("date", "k", "v").collect())
    assert got == [(dt.date(2024, 1, 1), "a", 9), (dt.date(2024, 1, 2), "b", 2)]
    assert scan(spark, target, ">=", "2024-01-02").count() == 1
    empty = os.path.join(tmp_dir, "empty")
    write_table(empty_table(spark, schemas.SESSIONS), empty, mode="overwrite")
    assert spark.read.parquet(empty).schema.names == schemas.SESSIONS.names
    js = [r.value for r in to_json_rows(df.orderBy("k")).collect()]
    assert js[0] == '{"date":"2024-01-01","k":"a","v":1}'
    text_out = os.path.join(tmp_dir, "json")
    to_json_rows(df).write.text(text_out)
    assert spark.read.text(text_out).count() == 2


def test_geo_csv_load_or_build(spark, tmp_dir):
    csv = os.path.join(tmp_dir, "geo.csv")
    with open(csv, "w") as f:
        f.write("StartIPNum,EndIPNum,Country,Local\n0,100,A,a\n,5,B,b\nx,7,C,c\n200,300,D,d\n")
    table = os.path.join(tmp_dir, "geo")
    g = load_or_build_geo(spark, csv, table)
    assert sorted(tuple(r) for r in g.collect()) == [(0, 100, "A", "a"), (200, 300, "D", "d")]
    with open(csv, "a") as f:
        f.write("400,500,E,e\n")
    assert load_or_build_geo(spark, csv, table).count() == 2  # stored table reused
    assert load_or_build_geo(spark, csv, table, force=True).count() == 3


def test_batch_to_two_targets_and_reset(spark, tmp_dir):
    from daypulse.streaming.ingest import reset_targets, write_batch
    df = spark.createDataFrame([(dt.date(2024, 1, 1), "a")], "date date, k string")
    a, b = os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "b")
    write_batch(df, 3, a, also_table=b)
    write_batch(df, 3, a, also_table=b)  # replay: same partitions rewritten
    assert spark.read.parquet(a).count() == spark.read.parquet(b).count() == 1
    reset_targets(spark, {"a": (a, df.schema)})
    assert spark.read.parquet(a).count() == 0


def test_batch_scope_dedup_and_preview(spark, tmp_dir):
    from daypulse.sinks.tables import save_and_preview
    body = '2024-01-02 00:00:00.000 {"actionType":"pay","purchaseNumber":"%s","totalPrice":%d}'
    lines = spark.createDataFrame([(body % ("p1", 5),), (body % ("p1", 3),), (body % ("p2", 1),)], "value string")
    target = os.path.join(tmp_dir, "pay")
    ingest.fan_out(ingest.server_rows(lines), 0, {"payment": target}, dedup_scope="batch")
    got = sorted((r.purchaseNumber, r.totalPrice) for r in spark.read.parquet(target).collect())
    assert got == [("p1", 3), ("p2", 1)]
    prev = save_and_preview(spark.read.parquet(target), os.path.join(tmp_dir, "copy"), n=1)
    assert prev.count() == 1


def test_session_moves_to_an_earlier_day(spark, tmp_dir):
    src, log, ckpt = (os.path.join(tmp_dir, n) for n in ("in", "log", "ckpt"))
    os.makedirs(src)
    d1 = D0 + dt.timedelta(days=1)
    first = [_client_line(_ms(d1), "u1", "s1")]
    late = [_client_line(_ms(d1) - 1000, "u1", "s1")]  # the day before; d1 is left without a session
    _write_lines(src, "a.txt", first)
    _session_stream(spark, src, log, ckpt)
    _assert_snapshot(spark, [log], first)
    _write_lines(src, "b.txt", late)
    _session_stream(spark, src, log, ckpt)
    assert [(r._id, r.date) for r in current_sessions(spark, log).collect()] == [("s1", D0.date())]
    _assert_snapshot(spark, [log], first + late)


def test_session_stream_on_rocksdb_state_store(spark, tmp_dir):
    from daypulse.session import CLUSTER_CONF
    key = "spark.sql.streaming.stateStore.providerClass"
    src, log = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "log")
    os.makedirs(src)
    lines = [_client_line(_ms(D0), "u1", "s1"), _client_line(_ms(D0) + 50, "u1", "s1")]
    for n, line in enumerate(lines):
        _write_lines(src, f"{n}.txt", [line])
    before = spark.conf.get(key, None)
    spark.conf.set(key, CLUSTER_CONF[key])
    try:
        stream = read_log_stream(spark, "text", path=src, max_per_trigger=1)
        q = start_session_job(ingest.client_rows(stream), log, os.path.join(tmp_dir, "c"), state="store",
                              trigger={"availableNow": True})
        _run(q)
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
    # the store carries the state over: the second logged row is the whole session
    last = spark.read.parquet(log).where("_batch_id = 1").collect()
    assert [(r._id, r.end_t - r.start_t) for r in last] == [("s1", 50)]
    _assert_snapshot(spark, [log], lines)
