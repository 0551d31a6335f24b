"""F2-F5 on worked cases: path, clean path, steps, value of a path parameter."""

import pytest
from pyspark.sql import functions as F

from daypulse.functions.urls import path_param, with_url_fields

# A step is a segment of letters that begins with a small letter. The value behind ``name`` is taken out, and the step
# after ``name`` or ``talkcloud`` is skipped; ``wechat`` is no step, and goes from the front of the clean path.
CASES = [
    ("", "", "", ""),
    ("/", "/", "", ""),
    ("/course/detail", "/course/detail", "course/detail/", ""),
    ("/wechat", "", "", ""),
    ("/wechat/", "/", "", ""),
    ("/wechat/course/12/detail/", "/course/12/detail/", "course/detail/", ""),
    ("/course/wechat/detail/", "/course/wechat/detail/", "course/detail/", ""),
    ("/wechat/name/ab/course", "/name/ab/course", "name/", ""),
    ("/name/ab/id/7/login/", "/name/ab/id/7/login/", "name/login/", ""),
    ("/course/name", "/course/name", "course/name/", ""),
    ("/pay/talkcloud/room/order/9/", "/pay/talkcloud/room/order/9/", "pay/talkcloud/order/", ""),
    ("/talkcloud/talkcloud/room", "/talkcloud/talkcloud/room", "talkcloud/room/", ""),
    ("/homeWorkReport/40/", "/homeWorkReport/40/", "homeWorkReport/", "40"),
    ("/a,B/x1/Zed/na", "/a,B/x1/Zed/na", "a,B/na/", ""),
    ("/id//detail", "/id//detail", "id/detail/", ""),
]


@pytest.mark.parametrize("slash", [False, True])
def test_url_fields_of_worked_cases(spark, slash):
    cases = {p + "/" if slash and p not in ("", "/wechat") and not p.endswith("/") else p: want for p, *want in CASES}
    df = spark.createDataFrame([("https://h.example.com" + p,) for p in cases], "url string")
    out = with_url_fields(df, "url").select("path", "clean", "steps", path_param("path", "homeWorkReport").alias("param"))
    got = {r.path: (r.clean.rstrip("/") or r.clean[:1], r.steps, r.param) for r in out.collect()}
    assert got == {p: (c.rstrip("/") or c[:1], s, v) for p, (c, s, v) in cases.items()}
    assert out.where(F.col("steps").contains("wechat")).count() == 0
