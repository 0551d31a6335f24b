"""Scalar functions F1-F11, P6-P11 on hand-worked inputs (FIXTURES.md)."""

import datetime as dt

from pyspark.sql import functions as F

from daypulse.functions import labels
from daypulse.functions.agents import browser, device, net_type, os_family, os_version, ua_language
from daypulse.functions.dates import epoch_millis, millis_to_date, safe_ratio
from daypulse.functions.net import ip_to_long
from daypulse.functions.urls import clean_path, decode_url, is_wechat, path_param, url_steps
from daypulse.operators.identity import combined_identity, funnel_identity


def _one(spark, expr, values, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_decode_url(spark):
    got = _one(spark, decode_url, ["a+b%20c", "bad%zz", None, "%E5%BC%A0", "x%2By"])
    assert got == ["a b c", "bad%zz", "", "张", "x+y"]


def test_clean_path_and_wechat(spark):
    urls = [
        "https%3A%2F%2Fh.example.com%2Fwechat%2Fcourse%2F12%2Fdetail%2F",
        "https://h.example.com:8080/index.html?#/mobile/5/name/ab/id/7/login",
        "http://h.example.com/a/wechat/b",
        "not a url",
        None,
    ]
    assert _one(spark, clean_path, urls) == [
        "/course/12/detail/", ":8080/mobile/5/name/ab/id/7/login", "/a/wechat/b", None, None]
    assert _one(spark, is_wechat, urls) == [True, False, False, None, None]


def test_url_steps(spark):
    urls = [
        "https://h.example.com/wechat/course/123/talkcloud/room/detail/name/ab/id/7/",
        "https://h.example.com/index.html?#/mobile/5/name/ab/id/7/login",
        "https://h.example.com/pay/talkcloud/room/order/9",
        "https://h.example.com/a,B/x1/",
        "https://h.example.com",
        None,
    ]
    assert _one(spark, url_steps, urls) == [
        "course/talkcloud/detail/name/",
        "mobile/name/login/",
        "pay/talkcloud/order/",
        "a,B/",
        "",
        None,
    ]


def test_url_steps_name_value_removed_everywhere(spark):
    # The value after ``name`` is deleted everywhere, even inside segments.
    url = "https://h.example.com/xab/name/ab/tail/"
    assert _one(spark, url_steps, [url]) == ["x/name/"]


def test_path_param(spark):
    paths = ["/homeWorkReport/42/", "/homeWorkReport/42", "/x/homeWorkReport/a/b", "/none/", None]
    got = _one(spark, lambda c: path_param(c, "homeWorkReport"), paths)
    assert got == ["42", "42", "a", "", None]


def test_ip_to_long(spark):
    ips = ["1.2.3.4", "255.255.255.255", "256.1.1.1", "1.2.3", "01.2.3.4", None, "0.0.0.0"]
    assert _one(spark, ip_to_long, ips) == [16909060, 4294967295, 0, 0, 0, 0, 0]


def test_user_agent_fields(spark):
    uas = ["Mozilla/5.0 (iPhone; CPU iPhone OS 11_2) NetType/WIFI Language/zh_CN",
           "Mozilla/5.0 (Linux; Android 8.0; X1) Chrome/66.0 NetType/4G Language/en",
           "curl/7.5", None]
    assert _one(spark, device, uas) == ["iPhone", "X1", "Unknown device", "Unknown device"]
    assert _one(spark, os_family, uas) == ["iOS", "Android", "Other", "Other"]
    assert _one(spark, os_version, uas) == ["iOS 11", "Android 8", "Other ", "Other "]
    assert _one(spark, browser, uas) == ["Mobile Safari UI/WKWebView", "Chrome", "curl", "Other"]
    assert _one(spark, net_type, uas) == ["WIFI", "4G", "unknown", "unknown"]
    assert _one(spark, ua_language, uas) == ["zh_CN", "en", "unknown", "unknown"]


def test_money_truncates_toward_zero(spark):
    got = _one(spark, labels.cents_to_units, [-199, 199, 100, None], "v bigint")
    assert got == [-1, 1, 1, None]
    df = spark.createDataFrame([(-199,), (199,), (100,)], "v bigint")
    exact = df.agg(labels.cents_exact(F.sum("v")).alias("x")).collect()[0]["x"]
    assert str(exact) == "1.00"


def test_labels(spark):
    assert _one(spark, labels.pay_channel_label, [2, 1, 77, None], "v int") == [
        "支付宝", "现金", labels.UNKNOWN_STATUS, None]
    assert _one(spark, labels.refund_status_name, [0, 2, 7, 9], "v int") == [
        "待审核", "待审核", "平台处理中", "待审核"]
    assert _one(spark, labels.route_of, ["pay", "refund_cancel", "refund_verify_success",
                                         "student_add", "signup_class", None]) == [
        "payment", "refund", None, "student", "signup", None]


def test_unknown_code_can_fail(spark):
    import pytest
    df = spark.createDataFrame([(77,)], "v int")
    with pytest.raises(Exception):
        df.select(labels.pay_channel_label("v", on_unknown="error")).collect()


def test_identity(spark):
    df = spark.createDataFrame([(None, "s1"), ("", "s1"), ("u1", "s1")], "uid string, _id string")
    rows = df.select(funnel_identity().alias("f"), combined_identity().alias("c")).collect()
    assert [(r.f, r.c) for r in rows] == [("s1", None), ("s1", "tmp_s1"), ("u1", "u1")]


def test_epoch_and_day(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 59, 59, 999999),)], "ts timestamp_ntz")
    ms = df.select(epoch_millis("ts").alias("ms")).collect()[0].ms
    assert ms == 1704153599999
    day = spark.createDataFrame([(ms,)], "t bigint").select(
        millis_to_date("t").alias("d"), millis_to_date("t", "Asia/Shanghai").alias("cn")).collect()[0]
    assert day.d == dt.date(2024, 1, 1) and day.cn == dt.date(2024, 1, 2)


def test_safe_ratio(spark):
    df = spark.createDataFrame([(1, 4), (0, 4), (3, 0), (None, 2)], "a bigint, b bigint")
    assert [r[0] for r in df.select(safe_ratio("a", "b")).collect()] == [0.25, 0.0, None, None]
