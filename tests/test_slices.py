"""Flows stored slice by slice: the same rows, with the shuffles of one slice at a time."""

from __future__ import annotations

import time
from functools import partial
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from meterloom.operators import enrich
from meterloom.session import freed_shuffles, scratch_path
from meterloom.sinks import slices
from meterloom.sinks import tables as sinks
from meterloom.workload import queries

SF_DIR = "/root/testdata/sf0.001"


def test_slices_hold_each_row_once(spark):
    df = spark.createDataFrame([(i, d) for i, d in enumerate("aabbbbbcd")] + [(9, None), (10, "")], "n long, d string")
    parts = slices.slices(df, F.col("d"), 3)
    found = [rows(df.filter(p), "n") for p in parts]
    # "" and null with "a"; "b" has more rows than a slice and stays whole
    assert found == [[(0,), (1,), (10,), (9,)], [(2,), (3,), (4,), (5,), (6,)], [(7,), (8,)]]
    for few in (df, df.filter("d IS NULL"), df.limit(0)):
        assert len(slices.slices(few, F.col("d"), 100)) == 1 and few.filter(slices.slices(few, F.col("d"), 100)[0]).count() == few.count()


def _shuffled(spark) -> set[str]:
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {p.name for d in dirs for p in Path(d.getPath()).glob("*/shuffle_*")}


def test_shuffle_files_go_with_their_query(spark):
    was, before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled"), _shuffled(spark)
    with freed_shuffles(spark):
        spark.range(1000).repartition(4, "id").write.parquet(scratch_path(spark, "freed"))
    until = time.time() + 20
    while _shuffled(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not _shuffled(spark) - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == was


@pytest.mark.parametrize("name", ["merge_readings", "incremental_feed"])
def test_queries_in_many_slices_yield_what_one_yields(spark, monkeypatch, name):
    whole = rows(queries.QUERIES[name](spark, SF_DIR))
    stored = []

    def in_slices(df, by, view, store, rows):
        slices.in_slices(df, by, view, lambda part: (stored.append(1), store(part)), rows)

    monkeypatch.setattr(queries, "slices", type("", (), {"in_slices": staticmethod(partial(in_slices, rows=2500))}))
    assert rows(queries.QUERIES[name](spark, SF_DIR)) == whole
    assert len(stored) > 1 and whole


def test_the_stored_copy_goes_when_its_slices_are_made(spark, monkeypatch):
    path, kept = scratch_path(spark, "sliced"), scratch_path(spark, "kept")
    monkeypatch.setattr(slices, "scratch_path", lambda s, label: kept)
    df = spark.range(100).withColumn("d", F.concat(F.lit("d"), F.col("id") % 7))
    slices.in_slices(df, F.col("d"), lambda p: p.groupBy("d").count(), lambda p: p.write.mode("append").parquet(path), 30)
    assert rows(spark.read.parquet(path)) == rows(df.groupBy("d").count())
    assert not Path(kept).exists()


def test_a_merge_in_slices_is_the_merge(spark):
    line = "day string, k long, v long, u string"
    target = [(f"d{i % 6}", i, i, "old") for i in range(60)] + [("d9", 1, 1, "old"), ("d1", None, 7, "old")]
    source = [(f"d{i % 7}", i, -i, "new") for i in range(40, 90)] + [("d1", None, 8, "new"), (None, 5, 9, "new")]
    results = []
    for most in (10**6, 9):
        path = scratch_path(spark, "merged")
        sinks.append_partitioned(spark.createDataFrame(target, line), path, ["day"])
        given = spark.createDataFrame(source, line)
        counts = sinks.write_merge(spark, given, path, ["day", "k"], ["v"], partition="day", label_col="u", slice_rows=most)
        results.append((counts, rows(spark.read.schema(line).parquet(path), "day", "k", "v", "u")))
    assert results[0] == results[1]
    twice = spark.createDataFrame([*source, ("d6", 48, 0, "new")], line)
    with pytest.raises(ValueError, match="more than one row"):
        sinks.write_merge(spark, twice, path, ["day", "k"], ["v"], partition="day", label_col="u", slice_rows=9)
    assert rows(spark.read.schema(line).parquet(path), "day", "k", "v", "u") == results[1][1]


def test_a_merge_whose_key_lacks_the_partition_is_not_sliced(spark):
    """Its rows may match in another partition than their own."""
    path, line = scratch_path(spark, "merged"), "day string, k long, v long"
    sinks.append_partitioned(spark.createDataFrame([("d1", 1, 1), ("d2", 2, 2)], line), path, ["day"])
    given = spark.createDataFrame([("d2", 1, 10), ("d1", 3, 30)], line)
    counts = sinks.write_merge(spark, given, path, ["k"], ["v"], partition="day", label_col=None, slice_rows=1)
    assert counts == {"update": 1, "insert": 1, "keep": 1}
    assert rows(spark.read.schema(line).parquet(path), "day", "k", "v") == [("d1", 1, 10), ("d1", 3, 30), ("d2", 2, 2)]


def test_assignments_that_can_hold_for_some_reading(spark):
    bounds = [(0, 5, 0, 99), (0, 10, 0, 99), (20, 30, 0, 99), (21, 30, 0, 99), (0, 99, 0, 9), (0, 99, 21, 30), (None, 99, 0, 99), (0, 99, 0, 99)]
    bounded = spark.createDataFrame([(i, *b) for i, b in enumerate(bounds)], ["n", *enrich.BOUNDS])
    readings = spark.createDataFrame([(10,), (20,), (None,)], "unix_endtime long")
    assert rows(enrich.valid_within(bounded, readings), "n") == [(1,), (2,), (7,)]
    assert rows(enrich.valid_within(bounded, readings.limit(0)), "n") == []
