"""Merge, feed, hold and table operations."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from conftest import rows
from pyspark.sql import functions as F

from meterloom import spec
from meterloom.operators import conform, dedup, hold, joins, merge
from meterloom.session import scratch_path
from meterloom.sinks import compaction
from meterloom.sinks import tables as sinks

SCHEMA = "day string, k string, v int, note string, hdp_update_user string"
KEYS, SET = ["day", "k"], ["v", "hdp_update_user"]


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def target(spark):
    return frame(
        spark,
        ("d1", "a", 1, "old", "load"),
        ("d1", "b", 2, "old", "load"),
        ("d1", None, 3, "old", "load"),
        ("d2", "c", 4, "old", "load"),
    )


def source(spark):
    return frame(
        spark,
        ("d1", "a", 10, "new", "in"),
        ("d1", "z", 11, "new", "in"),
        ("d1", None, 12, "new", "in"),
        ("d3", "q", 13, "new", "in"),
    )


MERGED = [
    ("d1", "a", 10, "old", "info-update"),
    ("d1", "b", 2, "old", "load"),
    ("d1", "z", 11, "new", "info-insert"),
    ("d1", None, 12, "new", "info-insert"),
    ("d1", None, 3, "old", "load"),
    ("d2", "c", 4, "old", "load"),
    ("d3", "q", 13, "new", "info-insert"),
]


def test_merge_upsert(spark):
    assert rows(merge.merge_upsert(target(spark), source(spark), KEYS, SET)) == MERGED


def test_merge_halves_and_metrics(spark):
    t, s = target(spark), source(spark)
    only_update = merge.merge_upsert(t, s, KEYS, SET, not_matched=False)
    assert rows(only_update, "k", "v") == [("a", 10), ("b", 2), ("c", 4), (None, 3)]
    only_insert = merge.merge_upsert(t, s, KEYS, SET, matched=False)
    assert rows(only_insert.filter("k = 'a'")) == [("d1", "a", 1, "old", "load")]
    assert only_insert.count() == 7
    metrics = merge.merge_metrics(merge.merge_upsert(t, s, KEYS, SET, keep_op=True), KEYS)
    assert rows(metrics) == [("insert", 3, 1), ("keep", 3, 1), ("update", 1, 0)]


def write_target(spark):
    path = scratch_path(spark, "t")
    target(spark).write.partitionBy("day").parquet(path)
    return path


def read_target(spark, path):
    return spark.read.schema(SCHEMA).parquet(path).select("day", "k", "v", "note", "hdp_update_user")


def test_write_merge(spark):
    path = write_target(spark)
    untouched = set(spark.read.parquet(f"{path}/day=d2").inputFiles())
    counts = sinks.write_merge(spark, source(spark), path, KEYS, SET, partition="day")
    assert counts == {"update": 1, "insert": 3, "keep": 2}
    assert rows(read_target(spark, path)) == MERGED
    assert set(spark.read.parquet(f"{path}/day=d2").inputFiles()) == untouched


def test_write_merge_keeps_the_targets_layout(spark):
    path = scratch_path(spark, "layout")
    kept = spark.sql("SELECT 'd1' AS day, 'a' AS k, CAST(1 AS FLOAT) AS v, 'old' AS note, 7 AS extra UNION ALL SELECT 'd1', 'b', CAST(2 AS FLOAT), 'old', 8")
    kept.write.partitionBy("day").parquet(path)
    news = spark.sql("SELECT 'd1' AS day, 'a' AS k, 5.5D AS v, 'new' AS note UNION ALL SELECT 'd1', 'c', 6D, 'new'")
    sinks.write_merge(spark, news, path, KEYS, ["v"], partition="day", label_col=None)
    after = spark.read.parquet(path)
    assert after.schema["v"].dataType.simpleString() == "float"
    assert rows(after, "k", "v", "note", "extra") == [("a", 5.5, "old", 7), ("b", 2.0, "old", 8), ("c", 6.0, "new", None)]
    with pytest.raises(ValueError, match="no column other"):
        sinks.write_merge(spark, news.withColumn("other", F.lit(1)), path, KEYS, ["v"], partition="day", label_col=None)


def test_write_merge_again_changes_only_labels(spark):
    path, complete = write_target(spark), source(spark).dropna(subset=["k"])
    sinks.write_merge(spark, complete, path, KEYS, SET, partition="day")
    first = rows(read_target(spark, path), "day", "k", "v", "note")
    counts = sinks.write_merge(spark, complete, path, KEYS, SET, partition="day")
    assert counts["insert"] == 0
    assert rows(read_target(spark, path), "day", "k", "v", "note") == first


def test_write_merge_empty_source_undated_rows_and_first_load(spark):
    path = write_target(spark)
    counts = sinks.write_merge(spark, source(spark).limit(0), path, KEYS, SET, partition="day")
    assert counts == {"update": 0, "insert": 0, "keep": 0} and read_target(spark, path).count() == 4
    undated = frame(spark, (None, "u", 1, "new", "in"))
    for _ in range(2):
        sinks.write_merge(spark, undated, path, KEYS, SET, partition="day")
    assert read_target(spark, path).filter("day is null").count() == 2
    fresh = scratch_path(spark, "fresh")
    assert sinks.write_merge(spark, source(spark), fresh, KEYS, SET, partition="day")["insert"] == 4
    assert read_target(spark, fresh).count() == 4


def test_write_merge_refuses_or_reduces_duplicates(spark):
    path = write_target(spark)
    twice = frame(spark, ("d1", "a", 5, "n", "in"), ("d1", "a", 6, "n", "in"))
    with pytest.raises(ValueError, match="more than one row"):
        sinks.write_merge(spark, twice, path, KEYS, SET, partition="day")
    assert read_target(spark, path).filter("k = 'a'").first()["v"] == 1
    sinks.write_merge(spark, twice, path, KEYS, SET, partition="day", order=["v"])
    assert read_target(spark, path).filter("k = 'a'").first()["v"] == 6


def test_latest_is_decided_by_instants(spark):
    held = spark.sql(
        "SELECT 'm' AS k, '2026-11-01T01:50:00-04:00' AS t, 'older' AS v UNION ALL SELECT 'm', '2026-11-01T01:10:00-05:00', 'newer'"
    )
    assert rows(dedup.keep_latest_collected(held, ["k"], "t"), "v") == [("newer",)]


def test_target_table(spark):
    name = f"t_{uuid.uuid4().hex}"
    sinks.create_target(spark, name, scratch_path(spark, "table"))
    sinks.create_target(spark, name, scratch_path(spark, "other"))  # exists: left alone
    described = {r["col_name"]: r["data_type"] for r in sinks.describe_target(spark, name).collect()}
    assert all(described[c] == spec.type_of(c) for c in spec.TARGET_COLUMNS)
    row = {c: None for c in spec.TARGET_COLUMNS} | {"serialnumber": "m", "aep_usage_dt": "2026-01-01", "value": 1.5}
    df = conform.consume(spark.createDataFrame([row], spec.ddl(sorted(row))))
    sinks.insert_target(df, name)
    assert rows(spark.table(name), "serialnumber", "aep_usage_dt", "value") == [("m", "2026-01-01", 1.5)]


def test_merge_into_a_named_table_registers_new_partitions(spark):
    name = f"t_{uuid.uuid4().hex}"
    sinks.create_target(spark, name, scratch_path(spark, "table"))

    def readings(*found):
        blank = {c: None for c in spec.TARGET_COLUMNS} | {"aep_meter_bucket": "01", "aep_channel_id": "1", "aep_raw_uom": "kwh"}
        made = [
            blank | {"serialnumber": s, "endtimeperiod": "e", "aep_usage_dt": day, "value": v, "toutier": tier}
            for s, day, v, tier in found
        ]
        return conform.consume(spark.createDataFrame(made, spec.ddl(sorted(blank))))

    sinks.insert_target(readings(("m", "2026-01-01", 1.5, "old"), ("n", "2026-01-01", 2.5, "old")), name)
    run = readings(("m", "2026-01-01", 3.5, "new"), ("m", "2026-01-02", 4.5, "new"), ("m", None, 5.5, "new"))
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    counts = sinks.write_merge(spark, run, name)
    assert counts == {"update": 1, "insert": 2, "keep": 1}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    found = rows(spark.table(name), "serialnumber", "aep_usage_dt", "value", "toutier")
    assert sorted(found, key=str) == sorted(
        [("m", "2026-01-01", 3.5, "old"), ("n", "2026-01-01", 2.5, "old"), ("m", "2026-01-02", 4.5, "new"), ("m", None, 5.5, "new")], key=str
    )
    assert dict(spark.table(name).dtypes) == {c: spec.type_of(c) for c in spec.TARGET_COLUMNS}


def test_drop_partitions_of_two_levels_and_odd_values(spark):
    name = f"t_{uuid.uuid4().hex}"
    made = spark.createDataFrame([(1, "it's", "a=b"), (2, "x/y", "20260101"), (3, "10:30", "c d")], "v int, p string, q string")
    made.write.partitionBy("p", "q").format("parquet").option("path", scratch_path(spark, "held")).saveAsTable(name)
    assert sinks.drop_partitions(spark, name) == 3
    assert spark.table(name).count() == 0 and sinks.drop_partitions(spark, name) == 0


def stage(spark):
    day = F.date_format(F.date_add(F.lit("2026-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd")
    return spark.range(200).select(
        F.lit("m").alias("serialnumber"), F.lit("e").alias("endtimeperiod"), F.lit("1").alias("aep_channel_id"),
        F.lit("kwh").alias("aep_raw_uom"), day.alias("int_gatewaycollectedtime"), day.alias("aep_usage_dt"),
    )


def test_hold_edges(spark):
    anchor = dt.date(2026, 7, 19)
    labelled = hold.hold_split(stage(spark), anchor=anchor)
    by_label = {r["hold_label"]: (r["a"], r["b"], r["n"]) for r in labelled.groupBy("hold_label").agg(
        F.min("aep_usage_dt").alias("a"), F.max("aep_usage_dt").alias("b"), F.count("*").alias("n")).collect()}
    assert by_label == {
        "expired": ("2026-01-01", "2026-01-14", 14),
        "hold": ("2026-01-15", "2026-07-03", 170),
        "keep": ("2026-07-04", "2026-07-19", 16),
    }
    assert hold.held(stage(spark), anchor=anchor).count() == 170
    assert hold.kept(stage(spark), anchor=anchor).count() == 16
    undated = stage(spark).limit(1).withColumn("aep_usage_dt", F.lit(None).cast("string"))
    assert rows(hold.hold_split(undated, anchor=anchor), "hold_label") == [("undated",)]
    assert hold.hold_split(stage(spark)).count() == 200  # today's anchor


def test_release_and_clear(spark):
    name = f"held_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} ({', '.join(f'{n} {k}' for n, k in stage(spark).dtypes)}, run_dt string) "
              f"USING parquet PARTITIONED BY (run_dt) LOCATION '{scratch_path(spark, 'held')}'")  # fmt: skip
    for run_dt in ("20260718", "20260719"):
        sinks.save_held_table(hold.held(stage(spark), run_dt, anchor=dt.date(2026, 7, 19)), name)
    held = spark.table(name)
    assert rows(hold.hold_audit(held).filter("aep_usage_dt = '2026-07-03'")) == [
        ("20260718", "2026-07-03", 1),
        ("20260719", "2026-07-03", 1),
    ]
    released = hold.hold_release(hold.kept(stage(spark), anchor=dt.date(2026, 7, 19)), held)
    assert released.count() == 17
    assert released.filter("aep_usage_dt = '2026-07-03'").count() == 1
    assert sinks.drop_partitions(spark, name) == 2
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 0


def test_feed_keeps_new_rows_of_one_unit(spark):
    base = {c: None for c in spec.TRANSFORM_COLUMNS}
    data = [base | {"data_type": d, "aep_opco": o} for d, o in (("new", "oh"), ("old", "oh"), ("new", "ap"))]
    df = spark.createDataFrame(data, spec.ddl(sorted(base)))
    assert rows(conform.incremental_feed(df, "oh", "x"), "aep_opco", "run_date") == [("oh", "x")]
    assert len(conform.incremental_feed(df, "oh").first()["run_date"]) == 15


# --- binned join -------------------------------------------------------------------------


def test_binned_join_of_one_meter_with_very_many_assignments(spark):
    """100,000 ranges of one meter, from minutes to decades: the same pairs, few comparisons."""
    day = 86_400
    ranges = spark.range(100_000).select(
        F.lit("m").alias("a_serial"),
        (F.col("id") * 3600).alias("first"),
        (F.col("id") * 3600 + F.expr(f"CASE id % 1000 WHEN 0 THEN {day * 4000} WHEN 1 THEN {day * 90} ELSE 1800 END")).alias("last"),
        F.col("id").alias("a"),
    )
    odd = spark.createDataFrame([("m", 10, 5, -1), ("m", None, 9, -2), ("m", 0, None, -3), ("m", -50, -50, -4), ("x", 0, 10**10, -5)], "a_serial string, first long, last long, a long")
    lookup = ranges.unionByName(odd).cache()
    readings = spark.range(0, 400).select(F.lit("m").alias("metername"), (F.col("id") * 777_777).alias("at"), F.col("id").alias("r"))
    readings = readings.unionByName(spark.createDataFrame([("m", -50, -1), ("m", None, -2), (None, 5, -3), ("x", 7, -4)], "metername string, at long, r long"))
    plain = readings.join(F.broadcast(lookup), (F.col("metername") == F.col("a_serial")) & F.col("at").between(F.col("first"), F.col("last")))
    for sizes in ({}, {"max_rows": 10}):
        got = joins.binned_join(readings, lookup, {"metername": "a_serial"}, "at", ("first", "last"), ["r"], **sizes)
        assert got.columns == plain.columns
        assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0
    entered = lookup.withColumn("e", F.explode(joins.cells_of(F.col("first"), F.col("last"))))
    assert entered.count() < 1.2 * lookup.count()
    tried = readings.join(entered, (F.col("metername") == F.col("a_serial")) & (joins.cell_at(F.col("at"), F.col("e.level")) == F.col("e.cell"))).groupBy("r").count()
    assert tried.agg(F.max("count")).first()[0] < 400  # of 100,000


def test_binned_join_without_ranges(spark):
    left = spark.createDataFrame([("m", 1)], "k string, at long")
    right = spark.createDataFrame([], "k2 string, first long, last long")
    assert joins.binned_join(left, right, {"k": "k2"}, "at", ("first", "last"), []).count() == 0


# --- file packing ------------------------------------------------------------------------


def test_compaction_joins_small_files_divides_large_ones_and_leaves_the_rest(spark):
    path = scratch_path(spark, "files")
    rows_ = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
    few = rows_.filter("id < 600").withColumn("day", F.lit("007"))
    few.repartition(12).write.mode("append").partitionBy("day").parquet(path)
    rows_.withColumn("day", F.lit("d large")).coalesce(1).write.mode("append").partitionBy("day").parquet(path)
    few.withColumn("day", F.lit(None).cast("string")).repartition(3).write.mode("append").partitionBy("day").parquet(path)
    rows_.filter("id < 8000").withColumn("day", F.lit("fits")).coalesce(1).write.mode("append").partitionBy("day").parquet(path)
    schema = "id long, v string, day string"
    before = spark.read.schema(schema).parquet(path).collect()
    kept = set(spark.read.schema(schema).parquet(f"{path}/day=fits").inputFiles())
    target = 500_000
    assert compaction.compact(spark, path, "day", target) > 0
    after = spark.read.schema(schema).parquet(path).collect()
    assert sorted(map(tuple, before), key=repr) == sorted(map(tuple, after), key=repr)
    assert set(spark.read.schema(schema).parquet(f"{path}/day=fits").inputFiles()) == kept
    sizes = {}
    for r in compaction.file_sizes(spark, path).collect():
        sizes.setdefault(r.folder, []).append(r.length)
    assert len(sizes["day=007"]) == 1 and len(sizes["day=__HIVE_DEFAULT_PARTITION__"]) == 1
    assert len(sizes["day=d%20large"] if "day=d%20large" in sizes else sizes["day=d large"]) > 1
    for listed in sizes.values():
        assert max(listed) <= compaction.LARGE * target and sum(x < compaction.SMALL * target for x in listed) <= 1
    assert compaction.compact(spark, path, "day", target) == 0  # nothing is left to do
