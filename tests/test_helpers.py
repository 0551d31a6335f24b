"""Small public helpers: catalog scans and drops, day arithmetic, geo CSV checks."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from daypulse.functions import dates
from daypulse.operators import bi, geo
from daypulse.sinks.tables import drop_target, path_exists, write_table
from daypulse.sources.tables import geo_from_csv, rejected_geo_rows, scan_table

D = dt.date


def test_catalog_scan_replace_and_drop(spark, tmp_dir):
    df = spark.createDataFrame([(1, D(2024, 1, 1)), (2, D(2024, 1, 2)), (3, D(2024, 1, 3))], "v int, date date")
    drop_target(spark, "helper_days")
    write_table(df, "helper_days", "date", "overwrite")
    assert sorted(r.v for r in scan_table(spark, "helper_days", ">=", "2024-01-02").collect()) == [2, 3]
    assert scan_table(spark, "helper_days").count() == 3
    # replace drops the days that the new rows do not have, in tables and in paths
    write_table(df.filter("v = 3"), "helper_days", "date", "replace")
    assert [r.v for r in spark.table("helper_days").collect()] == [3]
    path = os.path.join(tmp_dir, "days")
    write_table(df, path, "date", "replace")
    write_table(df.filter("v = 3"), path, "date", "replace")
    assert [r.v for r in spark.read.parquet(path).collect()] == [3]
    drop_target(spark, "helper_days")
    assert not path_exists(spark, "helper_days")
    with pytest.raises(ValueError):
        drop_target(spark, path)


def test_day_arithmetic(spark):
    df = spark.createDataFrame([(D(2024, 2, 28), D(2024, 2, 1), 1500), (None, D(2024, 2, 1), None)], "a date, b date, ms long")
    got = df.select(dates.shift_days("a", 2), dates.day_age("a", "b"), dates.ms_to_seconds("ms")).collect()
    assert [tuple(r) for r in got] == [(D(2024, 3, 1), 27, 1.5), (None, None, None)]
    inside = bi.date_range(df, "2024-02-28", "2024-03-01", "a").collect()
    assert len(inside) == 1


def test_wild_geo_bounds_are_dropped_and_named(spark, tmp_dir):
    csv = os.path.join(tmp_dir, "geo.csv")
    with open(csv, "w") as f:
        f.write("StartIPNum,EndIPNum,Country,Local\n0,4294967295,A,a\n5,9223372036854775807,B,b\n-3,7,C,c\n9,8,D,d\nx,1,E,e\n")
    assert [r.country for r in geo_from_csv(spark, csv).collect()] == ["A"]
    assert sorted(r.Country for r in rejected_geo_rows(spark, csv).collect()) == ["B", "C", "D", "E"]
    ranges = spark.createDataFrame([(5, 9223372036854775807, "B", "b"), (0, 100, "A", "a")],
                                   "start_ip long, end_ip long, country string, local_city string")
    ips = spark.createDataFrame([("0.0.0.7",)], "_ip string")
    for strategy in ("bucketed", "broadcast"):
        assert [r._location for r in geo.locate_ips(ips, ranges, strategy).collect()] == ["A a"]


def test_broadcast_form_checks_its_size(spark, monkeypatch):
    monkeypatch.setattr(geo, "MAX_BROADCAST_RANGES", 2)
    ranges = spark.range(3).select((F.col("id") * 10).alias("start_ip"), (F.col("id") * 10 + 5).alias("end_ip"),
                                   F.lit("A").alias("country"), F.lit("a").alias("local_city"))
    ips = spark.createDataFrame([("0.0.0.7",)], "_ip string")
    with pytest.raises(ValueError):
        geo.locate_ips(ips, ranges, "broadcast")
    assert geo.locate_ips(ips, ranges, "bucketed").count() == 1
