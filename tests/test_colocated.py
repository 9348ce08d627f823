"""The merge into a bucketed target: its rows, and that the target is not moved."""

from __future__ import annotations

import uuid

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_physical import explained, shuffles
from test_tables import KEYS, MERGED, SET, frame, source, target

from meterloom.session import scratch_path
from meterloom.sinks import colocated

COLUMNS = ["day", "k", "v", "note", "hdp_update_user"]
SHARED = "spark.sql.requireAllClusterKeysForCoPartition"


def bucketed(spark, df, keys=KEYS, buckets=4):
    name = f"bucketed_{uuid.uuid4().hex}"
    colocated.create_bucketed(spark, name, scratch_path(spark, "bucketed"), df.schema, "day", keys, buckets)
    colocated.load_bucketed(df, name)
    return name


def stored(spark, name):
    return rows(spark.table(name), *COLUMNS)


def test_rows_and_counts_are_those_of_the_plain_merge(spark):
    name = bucketed(spark, target(spark))
    assert colocated.layout(spark, name) == colocated.Layout(4, ["k"], "day")
    shared = spark.conf.get(SHARED)
    counts = colocated.merge_colocated(spark, source(spark), name, KEYS, SET)
    assert counts == {"update": 1, "insert": 3, "keep": 2}
    assert stored(spark, name) == MERGED
    assert spark.conf.get(SHARED) == shared
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("meterloom_merge_")]


def test_halves_of_the_merge(spark):
    only = bucketed(spark, target(spark))
    assert colocated.merge_colocated(spark, source(spark), only, KEYS, SET, not_matched=False) == {"update": 1, "insert": 0, "keep": 2}
    assert len(stored(spark, only)) == 4 and ("d1", "a", 10, "old", "info-update") in stored(spark, only)
    fresh = bucketed(spark, target(spark))
    assert colocated.merge_colocated(spark, source(spark), fresh, KEYS, SET, matched=False) == {"update": 0, "insert": 3, "keep": 3}
    assert ("d1", "a", 1, "old", "load") in stored(spark, fresh)


def test_undated_empty_and_refused_sources(spark):
    name = bucketed(spark, target(spark))
    undated = frame(spark, (None, "u", 1, "new", "in"), (None, None, 2, "new", "in"))
    assert colocated.merge_colocated(spark, undated, name, KEYS, SET) == {"update": 0, "insert": 2, "keep": 0}
    assert colocated.merge_colocated(spark, undated.limit(0), name, KEYS, SET) == {"update": 0, "insert": 0, "keep": 0}
    assert len(stored(spark, name)) == 6
    twice = source(spark).unionByName(source(spark))
    with pytest.raises(ValueError, match="more than one row"):
        colocated.merge_colocated(spark, twice, name, KEYS, SET)
    with pytest.raises(ValueError, match="no column other"):
        colocated.merge_colocated(spark, source(spark).withColumn("other", F.lit(1)), name, KEYS, SET)
    with pytest.raises(ValueError, match="in buckets of k"):
        colocated.merge_colocated(spark, source(spark), name, ["day", "v"], SET)
    assert len(stored(spark, name)) == 6
    # Of versions of one key the latest by the given order is merged, and an empty target takes all.
    empty = bucketed(spark, target(spark).limit(0))
    later = source(spark).withColumn("v", F.col("v") + 1)
    colocated.merge_colocated(spark, source(spark).unionByName(later).dropna(), empty, KEYS, SET, order=["v"])
    assert [r[2] for r in stored(spark, empty)] == [11, 12, 14]


def test_the_target_is_not_shuffled(spark):
    """One shuffle, of the source, for a key with and without the partition column; also where the
    session asks for many more partitions than there are buckets."""
    before = {k: spark.conf.get(k) for k in (SHARED, "spark.sql.sources.bucketing.autoBucketedScan.enabled", "spark.sql.shuffle.partitions")}
    for (k, _), v in zip(before.items(), ("false", "false", "64"), strict=True):
        spark.conf.set(k, v)
    try:
        for keys in (KEYS, ["k"]):
            name = bucketed(spark, target(spark), keys)
            staged = source(spark)
            part = colocated.touched_slice(spark.table(name), staged, "day")
            text = explained(colocated.merged_slice(part, staged, colocated.layout(spark, name), keys, SET, labels=("u", "i"), label_col=None))
            assert shuffles(text) == 1 and "Bucketed: true" in text
            assert "PartitionFilters: [day#" in text
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_files_stay_one_per_bucket_and_a_hot_meter_is_spread(spark):
    hot = spark.range(4000).select(
        F.lit("d1").alias("day"), F.col("id").cast("string").alias("k"), F.lit(1).alias("v"),
        F.lit("old").alias("note"), F.lit("load").alias("hdp_update_user"),
    )
    keys = ["day", "note", "k"]  # the meter is the same in all rows
    name = bucketed(spark, hot, keys)
    for _ in range(2):
        counts = colocated.merge_colocated(spark, hot.withColumn("v", F.lit(2)), name, keys, SET)
        assert counts == {"update": 4000, "insert": 0, "keep": 0}
    per_file = [r["count"] for r in spark.table(name).groupBy(F.input_file_name()).count().collect()]
    assert len(per_file) == 4 and max(per_file) < 2 * min(per_file)
