"""Clock changes, missing offsets and malformed times; the session zone must not matter."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from meterloom.functions import times as t
from meterloom.operators.filters import date_floor
from meterloom.operators.times import interval_times

CASES = [
    # end, minutes, start, end as shown, offset, epoch
    ("2026-02-19T15:30:00-05:00", "15", "2026-02-19T15:15:00-05:00", "2026-02-19T15:30:00-05:00", "-05:00", 1771533000),
    ("2026-03-08T03:00:00-04:00", "15", "2026-03-08T01:45:00-05:00", "2026-03-08T03:00:00-04:00", "-04:00", 1772953200),
    ("2026-11-01T01:00:00-05:00", "30", "2026-11-01T01:30:00-04:00", "2026-11-01T01:00:00-05:00", "-05:00", 1793512800),
    ("2026-07-01T00:00:00-04:00", "60", "2026-06-30T23:00:00-04:00", "2026-07-01T00:00:00-04:00", "-04:00", 1782878400),
    ("2026-02-19T20:30:00Z", "15", "2026-02-19T15:15:00-05:00", "2026-02-19T20:30:00+00:00", "+00:00", 1771533000),
    ("2026-02-19T15:30:00", "15", "2026-02-19T15:15:00-05:00", "2026-02-19T15:30:00-05:00", "-05:00", 1771533000),
    ("2026-02-19T15:30:00.000-05:00", "15", "2026-02-19T15:15:00-05:00", "2026-02-19T15:30:00-05:00", "-05:00", 1771533000),
    ("not a time", "15", None, None, None, None),
    ("2026-02-30T15:30:00-05:00", "15", None, None, "-05:00", None),
    (None, "15", None, None, None, None),
    ("2026-02-19T15:30:00-05:00", "n/a", None, "2026-02-19T15:30:00-05:00", "-05:00", 1771533000),
]


def _expected():
    return sorted(((e, m, s, shown, o, x) for e, m, s, shown, o, x in CASES), key=repr)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_interval_times(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([c[:2] for c in CASES], "int_endtime string, intervallength string")
        got = interval_times(df).select(
            "int_endtime", "intervallength", "starttime", "endtime", "interval_epoch", "unix_endtime"
        )
        assert rows(got) == _expected()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_compat_repeats_the_ends_offset(new_york):
    df = new_york.createDataFrame(
        [("2026-03-08T03:00:00-04:00", "15")], "int_endtime string, intervallength string"
    )
    assert rows(interval_times(df, compat=True), "starttime") == [("2026-03-08T01:45:00-04:00",)]
    assert rows(interval_times(df, keep_offset=False), "starttime", "endtime") == [
        ("2026-03-08T01:45:00", "2026-03-08T03:00:00")
    ]


def test_floor_equals_the_text_floor(spark):
    ends = [("2015-03-01T00:00:00-05:00",), ("2015-03-01T00:30:00-05:00",), ("2015-02-28T12:00:00-05:00",), ("bad",)]
    df = spark.createDataFrame(ends, "int_endtime string").withColumn("intervallength", F.lit("30"))
    for inclusive in (True, False):
        early = interval_times(df, floor="2015-03-01", inclusive=inclusive)
        late = date_floor(interval_times(df), "starttime", "2015-03-01", inclusive)
        assert rows(early) == rows(late)
    assert rows(interval_times(df, floor="2015-03-01"), "starttime") == [("2015-03-01T00:00:00-05:00",)]


def test_date_floor_kinds(spark):
    df = spark.createDataFrame(
        [("2015-02-28",), ("2015-03-01T00:00:00",), ("2015-03-02",), ("2015-13-01",), ("later",), (None,)], "s string"
    )
    assert rows(date_floor(df, "s")) == [("2015-03-01T00:00:00",), ("2015-03-02",)]
    assert rows(date_floor(df, "s", "2015-03-01", inclusive=False)) == [("2015-03-02",)]
    dates = spark.sql("SELECT explode(sequence(date'2015-02-27', date'2015-03-03')) AS s")
    assert date_floor(dates, "s").count() == 3
    assert date_floor(dates, "s", inclusive=False).count() == 2


def test_wall_forms(new_york):
    texts = ["1995-01-01", "1995-01-01 10:20:30", "1995-01-01 10:20:30.250000", "9999-01-01", "1995", "01/02/1995", "1995-02-30", None]
    df = new_york.createDataFrame([(x,) for x in texts], "x string").select("x", t.wall_text(t.wall_seconds("x")))
    assert dict(rows(df)) == {
        "1995-01-01": "1995-01-01T00:00:00",
        "1995-01-01 10:20:30": "1995-01-01T10:20:30",
        "1995-01-01 10:20:30.250000": "1995-01-01T10:20:30",
        "9999-01-01": "9999-01-01T00:00:00",
        **{x: None for x in texts[4:]},
    }


def test_first_interval_forms(spark):
    cases = {
        "02092026120000AM": "2026-02-09T00:00:00",
        "02092026120000PM": "2026-02-09T12:00:00",
        "02092026011530pm": "2026-02-09T13:15:30",
        "13092026011530PM": None,
        "02092026131530PM": None,
        "2026-02-09 13:15:30": "2026-02-09T13:15:30",
        "junk": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "x string").select("x", t.wall_text(t.first_interval_wall("x")))
    assert dict(rows(df)) == cases


def test_zone_convert_over_clock_changes(new_york):
    cases = {
        "2026-03-08T01:30:00": "2026-03-08T00:30:00",
        "2026-03-08T03:30:00": "2026-03-08T01:30:00",
        "2026-11-01T02:30:00": "2026-11-01T01:30:00",
    }
    df = new_york.createDataFrame([(k,) for k in cases], "x string")
    got = df.select("x", t.wall_text(t.zone_convert(t.end_wall("x"), "America/New_York", "America/Chicago")))
    assert dict(rows(got)) == cases


def test_run_stamp_day(spark):
    df = spark.createDataFrame([("20260301_040000",), ("20260302_040000",), ("x",), ("20261399_000000",)], "s string")
    assert dict(rows(df.select("s", t.run_stamp_day_name("s")))) == {
        "20260301_040000": "Sunday",
        "20260302_040000": "Monday",
        "x": None,
        "20261399_000000": None,
    }
