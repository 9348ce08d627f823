"""The physical shape that the operators rely on at scale."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from meterloom.operators import dedup, enrich, filters, hold
from meterloom.plans import interval_feed
from meterloom.sinks import tables as sinks
from meterloom.session import scratch_path
from meterloom.workload import queries, shapes

SF_DIR = "/root/testdata/sf0.001"


def explained(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def shuffles(text: str) -> int:
    tree = text.split("\n\n")[0]
    return len(re.findall(r"[-+ ]Exchange \(", tree))


@pytest.fixture(scope="module")
def source(spark):
    return interval_feed.source_view(shapes.documents(spark, SF_DIR), queries._uom(spark))


def test_keep_latest_limits_groups_before_the_shuffle(spark):
    text = explained(dedup.keep_latest(shapes.versions(spark, SF_DIR), ["l_orderkey", "l_linenumber"], ["l_shipdate"]))
    tree = text.split("\n\n")[0]
    assert tree.count("WindowGroupLimit") == 2 and shuffles(text) == 1
    assert tree.index("Exchange") < tree.rindex("WindowGroupLimit")


def test_consume_moves_the_readings_once(spark, source):
    text = explained(interval_feed.consume_view(source, queries._bounded(spark, SF_DIR), "oh"))
    # one shuffle of readings, one of the ten lookup rows for their distinct
    assert shuffles(text) == 2
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_consume_with_a_large_lookup(spark, source):
    bounded = queries._bounded(spark, SF_DIR)
    text = explained(enrich.assignment_join(source, bounded, pick="latest", max_rows=0))
    # readings and assignments on (key, salt), the window on the reading key, the unit distinct
    assert "SortMergeJoin LeftOuter" in text and "_salt" in text
    assert shuffles(text) == 4
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_adaptive_execution_may_split_a_hot_meter(spark):
    """The join under the window stays splittable: its partitioning is not the window's."""
    keys = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        hot = spark.range(40000).select(
            F.lit("MTR00000005").alias("metername"), F.col("id").cast("string").alias("endtime"),
            (F.lit(1500000000) + F.col("id")).alias("unix_endtime"), F.lit("1").alias("channel"), F.lit("a").alias("uom"),
        )
        bounded = queries.enrich.validity_bounds(shapes.assignments(spark, SF_DIR))
        df = enrich.assignment_join(hot.repartition(8), bounded, pick="latest", max_rows=0, salts=2)
        assert len(df.collect()) == 40000
        assert "isSkew=true" in df._jdf.queryExecution().executedPlan().toString() or "skew=true" in (
            df._jdf.queryExecution().executedPlan().toString()
        )
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_filters_reach_the_scan(spark):
    stored = scratch_path(spark, "held")
    shapes.held_stage(spark, SF_DIR).write.partitionBy("aep_opco").parquet(stored)
    df = spark.read.parquet(stored)
    held = explained(hold.held(df, anchor=queries.ANCHOR))
    assert "GreaterThanOrEqual(aep_usage_dt,2001-01-28)" in held
    floor = explained(filters.date_floor(df, "aep_usage_dt"))
    assert "GreaterThanOrEqual(aep_usage_dt,2015-03-01)" in floor
    back = explained(filters.read_back(df, "aep_opco", ["oh", "ap"]).select("value"))
    assert re.search(r"PartitionFilters: \[aep_opco#\d+ IN \((oh,ap|ap,oh)\)\]", back)
    assert re.search(r"ReadSchema: struct<value:double>", back)


def test_merge_reads_touched_partitions_only(spark):
    path = scratch_path(spark, "target")
    target = shapes.merge_input(spark, SF_DIR, "target")
    sinks.append_partitioned(target, path, ["ship_month"])
    touched = sinks.read_target(spark, path, target, "ship_month")
    text = explained(filters.read_back(touched, "ship_month", ["1998-07"]))
    assert re.search(r"PartitionFilters: \[isnotnull\(ship_month#\d+\), \(ship_month#\d+ = 1998-07\)\]", text)


def _lines(spark, folder):
    """Lines on both sides of the days that part target and source, and without a day."""
    days = ["1998-06-30 23:59:59", "1998-07-01 00:00:00", "1998-12-31 23:59:59.5", "1999-01-01 00:00:00", None]
    line = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_returnflag string, day string"
    df = spark.createDataFrame([(k, k + 1, k, 1, 10.0, "A", day) for k, day in enumerate(days)], line)
    made = df.withColumn("l_shipdate", F.col("day").cast("timestamp_ntz")).drop("day")
    made.coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


@pytest.mark.parametrize("side, kept", [("target", [0, 1, 2]), ("source", [1, 2, 3])])
def test_days_to_merge_are_compared_as_times(spark, tmp_path, side, kept):
    rows = shapes.merge_input(spark, _lines(spark, tmp_path), side)
    assert sorted(r[0] for r in rows.select("l_orderkey").collect()) == kept
    assert re.search(r"PushedFilters: \[IsNotNull\(l_shipdate\), (LessThan|GreaterThanOrEqual)\(l_shipdate,", explained(rows))


def test_a_replayed_source_is_not_copied_before_its_batches_are(spark, tmp_path, monkeypatch):
    labels = []
    monkeypatch.setattr(queries, "scratch_path", lambda s, label: labels.append(label) or scratch_path(s, label))
    assert queries.QUERIES["upsert_replay"](spark, _lines(spark, tmp_path)).count() == 4
    assert sorted(labels) == ["ledger", "target"]
