"""Keyed state of streams."""

from __future__ import annotations

import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from meterloom.session import scratch_path
from meterloom.streaming import intake

SCHEMA = "k string, n int, at timestamp"


def when(hour: float) -> dt.datetime:
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=hour)


def test_a_key_is_forgotten_after_its_time_and_late_rows_are_counted(spark):
    arriving, out, checkpoint = (scratch_path(spark, n) for n in ("arriving", "out", "cp"))

    def run(*data):
        spark.createDataFrame([(k, n, None if h is None else when(h)) for k, n, h in data], SCHEMA).coalesce(1).write.mode("append").parquet(arriving)
        stream = intake.stream_parquet(spark, arriving, spark.read.schema(SCHEMA).parquet(arriving).schema)
        return intake.run_once(intake.keep_first_for(stream, ["k"], "at", "10 hours", "2 hours"), out, checkpoint)

    def kept():
        return rows(spark.read.schema(SCHEMA).parquet(out), "k", "n")

    run(("a", 3, 1.0), ("a", 1, 0.0), ("a", 2, 0.0), ("b", 1, 5.0), (None, 7, 5.0), ("x", 9, None))
    assert kept() == [("a", 1), ("b", 1), (None, 7)]
    run(("a", 4, 10.0), ("a", 5, 10.5), ("b", 2, 14.0))  # ten hours after 0:00 is not after ten hours
    assert kept() == [("a", 1), ("a", 5), ("b", 1), (None, 7)]
    last = run(("c", 1, 40.0))
    assert intake.late_rows(last) == 0
    last = run(("a", 6, 20.0), ("a", 7, 39.0), ("b", 3, 39.0))  # the watermark is at 38:00
    assert intake.late_rows(last) == 1
    assert kept() == [("a", 1), ("a", 5), ("a", 7), ("b", 1), ("b", 3), ("c", 1), (None, 7)]
    held = run(("d", 1, 100.0)).recentProgress
    held += run(("e", 1, 101.0)).recentProgress
    assert held[-1]["stateOperators"][0]["numRowsTotal"] <= 2  # all older keys are forgotten


def test_kept_rows_do_not_depend_on_how_rows_are_dealt_to_batches(spark):
    data = spark.range(600).select(
        (F.col("id") * 7919 % 13).cast("string").alias("k"), F.col("id").cast("int").alias("n"), F.timestamp_seconds(F.col("id") * 1800).alias("at")
    )
    found = []
    for parts in (1, 4):
        arriving, out, checkpoint = (scratch_path(spark, n) for n in ("arriving", "out", "cp"))
        for part in range(parts):
            data.filter((F.col("n") >= 600 // parts * part) & (F.col("n") < 600 // parts * (part + 1))).coalesce(1).write.mode("append").parquet(arriving)
        stream = intake.stream_parquet(spark, arriving, data.schema, files_per_batch=1)
        intake.run_once(intake.keep_first_for(stream, ["k"], "at", "1 days"), out, checkpoint)
        found.append(rows(spark.read.schema(data.schema).parquet(out), "k", "n"))
    assert found[0] == found[1] and 13 < len(found[0]) < 600


def test_keys_share_calls_and_whole_numbers_stay_exact_beside_nulls(spark):
    """A thousand keys in four groups: Python is called for groups, and no key takes another's place."""
    big = (1 << 53) + 1
    data = spark.range(1000).select(
        F.when(F.col("id") % 100 != 7, F.lit(big) + F.col("id")).alias("k"),
        F.when(F.col("id") % 3 != 0, F.lit(big) + F.col("id")).alias("n"),
        F.timestamp_seconds(F.col("id") * 60 + 86400).alias("at"),
    )
    arriving, out, checkpoint = (scratch_path(spark, n) for n in ("arriving", "out", "cp"))
    data.coalesce(1).write.parquet(arriving)
    stream = intake.stream_parquet(spark, arriving, data.schema)
    last = intake.run_once(intake.keep_first_for(stream, ["k"], "at", "30 days", groups=4), out, checkpoint)
    expected = [(None if i % 100 == 7 else big + i, big + i if i % 3 else None) for i in range(1000) if i % 100 != 7 or i == 7]
    assert rows(spark.read.schema(data.schema).parquet(out), "k", "n") == sorted(expected, key=repr)
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in last.recentProgress if p["stateOperators"]) <= 4
