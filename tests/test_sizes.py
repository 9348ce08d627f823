"""What keeps work in proportion to the input: files, documents made once, sums over ranges."""

from __future__ import annotations

from pathlib import Path

from conftest import rows
from pyspark.sql import functions as F

from meterloom.operators import joins
from meterloom.session import scratch_path
from meterloom.sinks import colocated
from meterloom.sources import xml
from meterloom.workload import queries, shapes

SF_DIR = "/root/testdata/sf0.001"


def test_xml_files_are_compressed_and_hold_a_bounded_number_of_documents(spark):
    base = scratch_path(spark, "xml")
    documents = spark.range(10).coalesce(1).select(F.col("id").cast("string").alias("_MeterName"))
    xml.write_meter_xml(documents, base, file_documents=4)
    assert sorted(p.name[-7:] for p in Path(base).glob("part-*")) == [".xml.gz"] * 3
    assert rows(xml.read_meter_xml(spark, base), "_MeterName") == [(str(i),) for i in range(10)]


def test_the_described_target_stores_what_the_whole_flow_yields(spark):
    stored = {r["stored_rows"] for r in queries.QUERIES["describe_target"](spark, SF_DIR).collect()}
    assert stored == {queries.QUERIES["consume_view"](spark, SF_DIR).count()}


def test_totals_over_covering_ranges_make_no_pairs(spark):
    ranges = spark.createDataFrame(
        [("a", 1, 10, 20), ("a", 2, 20, 30), ("a", 4, 40, 35), ("a", 8, None, 50), ("b", 16, 0, 99), (None, 32, 0, 99)],
        "owner string, n long, first long, last long",
    )
    points = spark.createDataFrame(
        [(1, "a", 9), (2, "a", 10), (3, "a", 20), (3, "a", 20), (4, "a", 30), (5, "a", 31), (6, "a", 38), (7, "b", 99), (8, None, 5), (9, "a", None)],
        "p long, k string, at long",
    )
    found = joins.covering_totals(points, ranges, {"k": "owner"}, "at", ("first", "last"), "n")
    assert rows(found, "p", "covering", "covering_total") == [(2, 1, 1), (3, 2, 3), (3, 2, 3), (4, 1, 2), (7, 1, 16)]
    pairs = joins.binned_join(points.withColumn("at", F.col("at")), ranges, {"k": "owner"}, "at", ("first", "last"), ["p"])
    counted = pairs.groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("s"))
    summed = found.groupBy("p").agg(F.sum("covering").alias("n"), F.sum("covering_total").alias("s"))
    assert rows(counted, "p", "n", "s") == rows(summed, "p", "n", "s")


def test_a_key_with_many_ranges_needs_work_in_proportion(spark):
    """Every one of 20,000 ranges holds every one of 20,000 seconds: 400 million pairs."""
    ranges = spark.range(20_000).select(F.lit(1).alias("owner"), "id", F.lit(0).cast("long").alias("first"), F.lit(1 << 40).alias("last"))
    points = spark.range(20_000).select(F.lit(1).alias("k"), F.col("id").alias("at"))
    found = joins.covering_totals(points, ranges, {"k": "owner"}, "at", ("first", "last"), "id")
    assert rows(found.select("covering", "covering_total").distinct()) == [(20_000, 199_990_000)]


def test_buckets_follow_the_rows():
    assert [colocated.buckets_for(n) for n in (0, 600_000, 8_000_001, 216_000_000)] == [8, 8, 9, 216]


def test_rows_of_keys_with_few_ranges_are_not_copied(spark):
    """Ranges of three levels: readings were copied for each, and each range entered up to 33 times."""
    ranges = spark.range(2_000).select(
        F.concat(F.lit("k"), F.col("id")).alias("owner"), F.explode(F.array(*map(F.lit, (3, 800, 90_000)))).alias("days")
    ).select("owner", F.lit(0).cast("long").alias("first"), (F.col("days").cast("long") * 86400).alias("last"))
    points = spark.range(4_000).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.col("id").alias("p"), (F.col("id") * 86400).alias("at"))
    found = joins.binned_join(points, ranges, {"k": "owner"}, "at", ("first", "last"), ["p"], max_rows=0)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode(array(0") == 0 and "_ask" not in plan
    plain = points.join(ranges, (F.col("k") == F.col("owner")) & F.col("at").between(F.col("first"), F.col("last")))
    assert rows(found, "p", "last") == rows(plain, "p", "last")


def test_binned_join_of_keys_with_few_and_many_ranges(spark):
    ranges = spark.createDataFrame(
        [("a", i, 86400 * i, 86400 * (i + 1 + i % 5 * 40)) for i in range(300)]
        + [("b", 1, 0, 1 << 40), ("b", 2, 86400 * 50, 86400 * 60), ("b", 3, 9, 8), (None, 4, 0, 99), ("a", 5, None, 99)],
        "owner string, n long, first long, last long",
    )
    points = spark.createDataFrame(
        [(i, k, 43200 * i) for i in range(120) for k in ("a", "b", "c", None)] + [(7, "a", None), (8, "b", 86400 * 50), (8, "b", 86400 * 50)],
        "p long, k string, at long",
    )
    inside = (F.col("k") == F.col("owner")) & F.col("at").between(F.col("first"), F.col("last"))
    wanted = rows(points.join(ranges, inside), "p", "k", "n")
    for sizes in ({}, {"max_rows": 0}):
        assert rows(joins.binned_join(points, ranges, {"k": "owner"}, "at", ("first", "last"), ["p"], **sizes), "p", "k", "n") == wanted
