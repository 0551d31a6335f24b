"""Log parsing (S3/S4, P1-P3) and the batch session rules."""

import datetime as dt

from pyspark.sql import types as T

from daypulse.operators import logs, sessions

D0 = dt.date(2024, 1, 1)


def test_server_lines(spark):
    lines = ["x" * 24,
             "2024-01-02 00:00:00.000 {\"actionType\":\"pay\",\"studentId\":5}",
             "2024-01-03 00:00:00.000 {}",
             "2024-01-04 00:00:00.000 {bad json",
             "short"]
    df = spark.createDataFrame([(v,) for v in lines], "line string")
    out = logs.parse_server_lines(df).orderBy("date").collect()
    assert len(out) == 3  # length <= 24 dropped
    ok, empty, bad = out
    assert (ok.date, ok.actionType, ok.studentId, ok._corrupt) == (dt.date(2024, 1, 2), "pay", 5, None)
    assert (empty.actionType, empty._corrupt) == (None, None)
    assert bad.actionType is None and bad._corrupt == "{bad json"


def test_json_rows_explicit_schema(spark):
    schema = T.StructType([T.StructField("t", T.LongType()), T.StructField("uid", T.StringType())])
    df = spark.createDataFrame([('{"t": 5, "uid": "u", "extra": 1}',), ('{"uid": "v"}',), ("nope",)],
                               "value string")
    rows = logs.parse_json(df, "value", schema).collect()
    assert [(r.t, r.uid) for r in rows] == [(5, "u"), (None, "v"), (None, None)]
    assert rows[2]._corrupt == "nope"
    landed = logs.land_client_rows(logs.parse_json(df, "value", schema)).collect()
    assert len(landed) == 1 and landed[0].date == dt.date(1970, 1, 1)


def test_router_and_video(spark):
    rows = [("pay",), ("refund_verify_failure",), ("refund_verify_success",), (None,)]
    df = spark.createDataFrame(rows, "actionType string")
    assert [r.route for r in logs.with_route(df).collect()] == ["payment", "refund", None, None]
    assert logs.route(df, "refund").count() == 1
    ev = spark.createDataFrame([(D0, "userBehavior", "lessonPlaybackTriggered"), (D0, None, None),
                                (D0, "userBehavior", "x")], "date date, e_c string, e_a string")
    assert [tuple(r) for r in logs.video_playbacks(ev).collect()] == [(D0, 1)]


CLIENT = "t bigint, date date, uid string, _id string"


def test_session_rules(spark):
    rows = [(0, D0, "", "s1"), (60, D0, "u1", "s1"), (120, D0, "u2", "s1"),  # late uid: first non-empty
            (10, D0, "", "s2"), (40, D0, "", "s2"),  # anonymous -> tmp_s2
            (5, D0, None, "s3")]  # null uid dropped
    df = spark.createDataFrame(rows, CLIENT)
    roll = {r._id: r for r in sessions.session_rollup(df).collect()}
    assert set(roll) == {"s1", "s2"}
    assert (roll["s1"].uid, roll["s1"].start_t, roll["s1"].end_t) == ("u1", 0, 120)
    assert roll["s2"].uid == ""
    dps = {r.combined_id: r for r in sessions.session_datapoints(sessions.session_rollup(df)).collect()}
    assert (dps["u1"].session_length, dps["u1"].session_count) == (120, 1)
    assert (dps["tmp_s2"].session_length, dps["tmp_s2"].session_count) == (30, 1)


def test_sessions_tables(spark):
    rows = [(D0, "a", D0, 10, 1), (D0 + dt.timedelta(days=1), "a", D0, 5, 2),
            (D0 + dt.timedelta(days=1), "b", D0 + dt.timedelta(days=1), 7, 1)]
    s = spark.createDataFrame(rows, "date date, combined_id string, earliest_date date, "
                                    "session_length bigint, session_count bigint")
    nu = {r.date: r.new_users for r in sessions.new_users(s).collect()}
    assert nu == {D0: 1, D0 + dt.timedelta(days=1): 1}
    ad = {r.date: r for r in sessions.active_datapoints(s).collect()}
    assert (ad[D0].dau, ad[D0].wau, ad[D0].mau) == (1, 1, 1)
    wau = [ad[D0 + dt.timedelta(days=k)].wau for k in (7, 8, 9)]
    assert wau == [3, 2, 0]
    assert ad[D0 + dt.timedelta(days=31)].mau == 2 and D0 + dt.timedelta(days=32) not in ad
    rc = {r.date: r.d1_returning for r in sessions.returning_counts(s).collect()}
    assert rc == {D0: 0, D0 + dt.timedelta(days=1): 1}
    log = s.unionByName(s.withColumn("session_length", s.session_length - 1))
    assert sorted(tuple(r) for r in sessions.snapshot(log).collect()) == sorted(tuple(r) for r in s.collect())


def test_server_refund_records(spark):
    body = ('2024-01-05 00:00:00.000 {"actionType":"refund_apply","purchaseNumber":"p1","studentId":7,'
            '"money":100,"purchaseMoney":900,"status":%d%s}')
    lines = [body % (2, ',"verifyTime":86400000,"updateTime":0'), body % (6, ',"updateTime":0'),
             body % (9, ""), body.replace("refund_apply", "pay") % (1, "")]
    df = logs.parse_server_lines(spark.createDataFrame([(x,) for x in lines], "line string"))
    rows = logs.server_refund_records(df).orderBy("status").collect()
    assert [(r.status, r.statusName, r.date, r.verifyTime) for r in rows] == [
        (2, "待审核", dt.date(1970, 1, 2), dt.date(1970, 1, 2)),
        (6, "退费成功(线上)", dt.date(1970, 1, 1), None),
        (9, "待审核", dt.date(2024, 1, 5), None)]
    assert rows[0].refundMoney == 100 and rows[0].userId == 7


def test_server_payment_records(spark):
    body = '2024-01-05 00:00:00.000 {"actionType":"pay","purchaseNumber":"p1","studentId":7,"totalPrice":990%s}'
    lines = [body % ',"payTime":86400000', body % ""]
    df = logs.parse_server_lines(spark.createDataFrame([(x,) for x in lines], "line string"))
    got = sorted((r.payTime is None, r.date) for r in logs.server_payment_records(df).collect())
    assert got == [(False, dt.date(1970, 1, 2)), (True, dt.date(2024, 1, 5))]
