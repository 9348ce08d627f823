"""Real files: XML, delimited text, ready markers, streams."""

from __future__ import annotations

import pytest

import datetime as dt
import gzip
import os

from conftest import rows
from pyspark.sql import functions as F

from meterloom.operators import filters, flatten
from meterloom.sources import listing, tables, wide, xml
from meterloom.streaming import intake

NS = """<f:Feed xmlns:f="urn:x"><f:MeterData MeterName="007A"><f:IntervalReadData IntervalLength="15">
<f:Interval EndTime="2026-01-01T00:15:00-05:00"><f:Reading Channel="1" RawValue="1" Value="2" UOM="kWh"/></f:Interval>
</f:IntervalReadData></f:MeterData></f:Feed>"""
BROKEN = """<Feed><MeterData MeterName="ok"/><MeterData MeterName="cut"><IntervalReadData></MeterData></Feed>"""


def test_xml_files(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / name).mkdir()
        with gzip.open(tmp_path / name / "f.xml.gz", "wt") as out:
            out.write(NS)
    df = xml.read_meter_xml(spark, [f"{tmp_path}/a", f"{tmp_path}/b/*.gz"], part_date="p", spread=3)
    assert df.rdd.getNumPartitions() == 3
    got = flatten.flatten_readings(df).select("metername", "value", "part_date", F.substring_index("filename", "/", -2))
    assert rows(got) == [("007A", 2.0, "p", "a/f.xml.gz"), ("007A", 2.0, "p", "b/f.xml.gz")]
    nested = xml.read_meter_xml(spark, str(tmp_path), recursive=True)
    assert nested.count() == 2
    inferred = xml.read_meter_xml(spark, [f"{tmp_path}/a"], infer=True)
    assert "_MeterName" in inferred.columns


def test_corrupt_xml(spark, tmp_path):
    (tmp_path / "f.xml").write_text(BROKEN)
    kept = xml.read_meter_xml(spark, str(tmp_path))
    assert tuple(xml.corrupt_rows(kept).first())[:2] == (2, 1)
    strict = xml.read_meter_xml(spark, str(tmp_path), mode="FAILFAST")
    try:
        strict.collect()
        raise AssertionError("FAILFAST accepted a broken record")
    except Exception as error:
        assert "MALFORMED" in str(error).upper()


def test_delimited(spark, tmp_path):
    line = ["r", "1", "", "p", "e", "Y", "LG1", "1", "E", "KWH", "1", "900", "3", "01012026110000PM"]
    (tmp_path / "f.txt").write_text("~".join([*line, "q1", "1.5", "", "", "q3", "3.5"]) + "\n")
    df = wide.read_wide_text(spark, str(tmp_path), n_pairs=3)
    assert df.first()["timestamp"] is None and len(df.columns) == 21
    assert rows(wide.wide_values_array(df, 3).select("value")) == [(["1.5", None, "3.5"],)]
    long = wide.wide_to_long(df, 3, target_zone="America/Chicago")
    assert rows(long, "position", "value", "starttime", "endtime") == [
        (1, 1.5, "2026-01-01T22:00:00-06:00", "2026-01-01T22:15:00-06:00"),
        (3, 3.5, "2026-01-01T22:30:00-06:00", "2026-01-01T22:45:00-06:00"),
    ]
    assert wide.wide_to_long(df, 3, drop_gaps=False).count() == 3
    assert wide.wide_to_long(df, 3, target_zone="America/Chicago", floor="2026-01-02").count() == 0
    assert wide.wide_to_long(df, 3, floor="2026-01-01").count() == 2


def test_ready_files(spark, tmp_path):
    def put(path, at, content="x"):
        file = tmp_path / path
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(content)
        os.utime(file, (at, at))

    start, end = 1_700_000_000, 1_700_000_100
    put("now/index.txt", start), put("now/1.xml.gz", 1), put("now/sub/2.xml", 1)
    put("now/empty.xml", 1, ""), put("now/notes.txt", 1)
    put("early/index.txt", start - 1), put("early/1.xml", start)
    put("late/index.txt", end), put("late/1.xml", start)
    put("deep/sub/index.txt", start), put("deep/1.xml", start)
    put("none/1.xml", start)
    files = listing.with_layout(listing.list_files(spark, str(tmp_path)), str(tmp_path))
    window = [dt.datetime.fromtimestamp(x, dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S") for x in (start, end)]
    for bound in (1000, 0):
        ready = listing.ready_files(files, *window, max_rows=bound)
        assert rows(ready, "directory", "file_name") == [("now", "1.xml.gz"), ("now", "2.xml")]
    assert rows(listing.ready_files_summary(ready)) == [("now", 2, 2)]


def test_batch_window_and_read_back(spark):
    df = spark.sql("SELECT explode(sequence(timestamp_ntz'2026-01-01', timestamp_ntz'2026-01-03', interval 1 day)) AS ts")
    control = spark.sql("SELECT timestamp_ntz'2026-01-02' AS last_processed")
    assert filters.batch_window(df, "ts", control=control).count() == 2
    assert filters.batch_window(df, "ts", "2026-01-01", "2026-01-02").count() == 1
    assert filters.read_back(df, "ts", []).count() == 0
    with pytest.raises(ValueError, match="no last processed"):
        filters.batch_window(df, "ts", control=control.limit(0))


def test_layout_when_the_base_name_recurs(spark):
    files = spark.sql("SELECT 'file:/data/b1/data/f.xml' AS path")
    assert rows(listing.with_layout(files, "/data"), "directory", "depth", "file_name") == [("b1", 3, "f.xml")]


def test_catalog_lookup(spark):
    tables.sample_uom(spark).withColumn("aep_opco", F.lit("ap")).createOrReplaceTempView("some_uom")
    assert tables.uom_lookup(spark, "ap", "some_uom").count() == 10
    assert tables.uom_lookup(spark, "oh", "some_uom").count() == 0
    assert tables.uom_lookup(spark, "oh", "missing_uom").count() == 10


def test_stream_reads_only_what_is_new(spark, tmp_path):
    feed, out, mark = (str(tmp_path / n) for n in ("feed", "out", "mark"))
    os.mkdir(feed)
    for n, expected in ((1, 1), (2, 2), (2, 2)):
        with open(f"{feed}/{n}.xml", "w") as file:
            file.write(NS)
        os.utime(f"{feed}/{n}.xml", (n, n))
        readings = flatten.flatten_readings(intake.stream_meter_xml(spark, feed))
        intake.run_once(readings, out, mark)
        assert spark.read.parquet(out).count() == expected


def test_stream_keeps_first(spark, tmp_path):
    feed, out, mark = (str(tmp_path / n) for n in ("feed", "out", "mark"))
    df = spark.sql("SELECT id % 5 AS k, timestamp'2026-01-01' + make_interval(0,0,0,0,0,0,id) AS ts FROM range(100)")
    for _ in range(2):
        df.write.mode("append").parquet(feed)
        first = intake.keep_first(intake.stream_parquet(spark, feed, df.schema), ["k"], "ts", "1 hour")
        intake.run_once(first, out, mark)
    assert rows(spark.read.parquet(out), "k") == [(i,) for i in range(5)]


def test_stream_upsert_batches(spark, tmp_path):
    feed, target, mark = (str(tmp_path / n) for n in ("feed", "target", "mark"))
    seen = []
    for value in (1, 2):
        df = spark.createDataFrame([("d", "a", value, "u")], "day string, k string, v int, hdp_update_user string")
        df.write.mode("append").parquet(feed)
        intake.upsert_stream(
            intake.stream_parquet(spark, feed, df.schema), target, mark, ["day", "k"], ["v"],
            update_cols=["v", "hdp_update_user"], partition="day", on_batch=lambda i, c: seen.append(c),
        )
    assert rows(spark.read.schema(df.schema).parquet(target), "k", "v", "hdp_update_user") == [("a", 2, "info-update")]
    assert [c["insert"] for c in seen] == [1, 0]


def test_bad_documents_are_kept_apart_and_leave_once_they_parse(spark):
    from meterloom.session import scratch_path
    from meterloom.sources import quarantine

    path = scratch_path(spark, "quarantine")
    good, cut, unnamed = '<MeterData MeterName="m"/>', '<MeterData MeterName="c">', '<MeterData MacID="x"/>'
    texts = spark.createDataFrame([("f1", good), ("f1", good), ("f2", cut), ("f3", unnamed), ("f4", None), ("f5", "junk")], "file string, xml string")

    def take():
        return sorted(r._origin for r in quarantine.take(texts, "xml", F.col("file"), path, "b").collect())

    assert take() == take() == ["f1", "f1"]  # a second run replaces the first
    causes = {r.origin: (r.cause, r.text) for r in quarantine.open_entries(spark, path, "b").collect()}
    assert causes == {"f2": ("malformed", cut), "f3": ("unnamed", unnamed), "f4": ("malformed", None), "f5": ("malformed", "junk")}
    assert quarantine.replay(spark, path, "b").count() == 0
    mended = quarantine.replay(spark, path, "b", lambda t: F.concat(t, F.lit("</MeterData>")))
    assert [(r._origin, r._MeterName) for r in mended.collect()] == [("f2", "c")]
    named = quarantine.replay(spark, path, "b", lambda t: F.replace(t, F.lit("MacID"), F.lit("MeterName")))
    assert [(r._origin, r._MeterName) for r in named.collect()] == [("f3", "x")]
    left = quarantine.open_entries(spark, path, "b").collect()
    assert sorted((r.origin, r.attempt) for r in left) == [("f4", 4), ("f5", 4)]
    assert quarantine.entries(spark, path, "b").filter("closed").count() == 2
    with pytest.raises(ValueError, match="has been replayed"):
        take()
    assert quarantine.replay(spark, path, "none").count() == 0


def test_quarantine_writes_the_texts_of_entered_documents_only(spark, monkeypatch):
    from meterloom.session import scratch_path
    from meterloom.sources import quarantine

    staged, stage_once = [], quarantine.stage_once
    monkeypatch.setattr(quarantine, "stage_once", lambda df, label: staged.append(stage_once(df, label)) or staged[-1])
    path, good = scratch_path(spark, "quarantine"), '<MeterData MeterName="m1"/>'
    texts = spark.createDataFrame([(good,), ("<MeterData",), (None,), ("<MeterData/>",)], "xml string")
    assert quarantine.take(texts, "xml", F.lit("f"), path, "b").count() == 1
    assert quarantine.replay(spark, path, "b", lambda t: F.when(t == "<MeterData", F.lit(good)).otherwise(t)).count() == 1
    first, second = ([c for row in df.collect() for c in row if c in (good, "<MeterData", "<MeterData/>")] for df in staged)
    assert sorted(first) == ["<MeterData", "<MeterData/>"]
    assert sorted(second) == ["<MeterData", "<MeterData/>"]
    closed = quarantine.entries(spark, path, "b").filter("closed").collect()
    assert [(r.text, r.cause, r.attempt) for r in closed] == [("<MeterData", None, 2)]
