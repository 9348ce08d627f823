"""Batches, releases and windows that are run again, cut off or raced."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_tables import KEYS, MERGED, SCHEMA, SET, frame, read_target, source, write_target

from meterloom.session import scratch_path
from meterloom.sinks import ledger, release
from meterloom.sinks import tables as sinks
from meterloom.sources import control, listing
from meterloom.streaming import intake


class Stop(Exception):
    pass


def at(state):
    def told(reached):
        if reached == state:
            raise Stop

    return told


# --- ledger ------------------------------------------------------------------------------


@pytest.mark.parametrize("state", [None, ledger.STAGED, ledger.DONE])
def test_a_replayed_batch_inserts_rows_without_a_key_once(spark, state):
    path, log = write_target(spark), scratch_path(spark, "log")

    def run(on_state=None):
        return ledger.merge_once(spark, source(spark), path, "s", 7, log, KEYS, SET, partition="day", on_state=on_state)

    if state:
        with pytest.raises(Stop):
            run(at(state))
    counts = [run(), run()]
    assert counts[0] == counts[1] == {"update": 1, "insert": 3, "keep": 2}
    assert rows(read_target(spark, path)) == MERGED
    (entry,) = ledger.batches(spark, log, "s").collect()
    assert (entry.state, entry.partitions) == (ledger.DONE, ["d1", "d3"])


def test_a_batch_cut_off_before_it_is_staged_reads_its_source_anew(spark):
    path, log = write_target(spark), scratch_path(spark, "log")
    with pytest.raises(ValueError, match="no column other"):
        ledger.merge_once(spark, source(spark).withColumn("other", F.lit(1)), path, "s", 0, log, KEYS, SET, partition="day")
    assert ledger.batches(spark, log).count() == 0
    ledger.merge_once(spark, source(spark), path, "s", 0, log, KEYS, SET, partition="day")
    assert rows(read_target(spark, path)) == MERGED
    with pytest.raises(ValueError, match="was entered for"):
        ledger.merge_once(spark, source(spark), write_target(spark), "s", 0, log, KEYS, SET, partition="day")


def test_undated_rows_and_empty_batches(spark):
    path, log = write_target(spark), scratch_path(spark, "log")
    undated = frame(spark, (None, "u", 1, "new", "in"), (None, None, 2, "new", "in"))
    merge = lambda batch, df, **o: ledger.merge_once(spark, df, path, "s", batch, log, KEYS, SET, partition="day", **o)
    for _ in range(2):
        assert merge(0, undated) == {"update": 0, "insert": 2, "keep": 0}
        assert merge(1, undated.limit(0)) == {"update": 0, "insert": 0, "keep": 0}
    assert read_target(spark, path).filter("day is null").count() == 2
    assert merge(2, undated.limit(1)) == {"update": 0, "insert": 1, "keep": 2}  # another batch is another insert
    assert merge(3, undated, not_matched=False) == {"update": 0, "insert": 0, "keep": 0}
    assert read_target(spark, path).count() == 7 and ledger.batches(spark, log).count() == 4


def test_a_named_table_keeps_its_rows_over_replays(spark):
    name, log = f"ledger_{uuid.uuid4().hex}", scratch_path(spark, "log")
    spark.sql(f"CREATE TABLE {name} (k string, v int, note string, hdp_update_user string, day string) USING parquet PARTITIONED BY (day) LOCATION '{scratch_path(spark, 'named')}'")
    for _ in range(2):
        ledger.merge_once(spark, source(spark), name, "s", 0, log, KEYS, SET, partition="day")
    assert rows(spark.table(name), "day", "k", "v") == [("d1", "a", 10), ("d1", "z", 11), ("d1", None, 12), ("d3", "q", 13)]


def test_a_stream_that_fails_after_a_merge_repeats_the_batch_without_effect(spark):
    path, log, incoming, checkpoint = write_target(spark), *(scratch_path(spark, n) for n in ("log", "in", "cp"))
    source(spark).coalesce(1).write.parquet(incoming)
    failed = []

    def on_batch(batch, counts):
        if not failed:
            failed.append(batch)
            raise Stop

    def run():
        stream = intake.stream_parquet(spark, incoming, spark.read.schema(SCHEMA).parquet(incoming).schema)
        intake.upsert_stream(stream, path, checkpoint, KEYS, ["v"], on_batch, ledger=log, update_cols=SET, partition="day")

    with pytest.raises(Exception, match="Stop"):
        run()
    run()
    assert failed == [0] and rows(read_target(spark, path)) == MERGED
    frame(spark, ("d1", None, 99, "new", "in")).write.mode("append").parquet(incoming)
    run()
    assert read_target(spark, path).filter("k is null").count() == 3


# --- release -----------------------------------------------------------------------------

HELD = "serialnumber string, endtimeperiod string, aep_channel_id string, aep_raw_uom string, int_gatewaycollectedtime string, value double"


def reading(meter, collected, value):
    return (meter, "e", "1", "kwh", collected, value)


@pytest.fixture
def hold_table(spark):
    name = f"held_{uuid.uuid4().hex}"
    for run, data in (("r'1", [reading("a", "1", 1.0), reading("b", "1", 2.0)]), ("r2", [reading("a", "2", 3.0)])):
        sinks.save_held_table(spark.createDataFrame(data, HELD).withColumn("run_dt", F.lit(run)), name)
    return name


def test_a_run_held_in_between_survives_the_release(spark, hold_table):
    path, log = scratch_path(spark, "stage"), scratch_path(spark, "manifest")
    stage = spark.createDataFrame([reading("own", "1", 0.0)], HELD)
    assert release.begin_release(spark, hold_table, log, "one") == {"r'1": 2, "r2": 1}
    late = spark.createDataFrame([reading("c", "3", 9.0)], HELD).withColumn("run_dt", F.lit("r3"))
    sinks.save_held_table(late, hold_table)
    for _ in range(2):
        assert release.release(spark, stage, hold_table, path, log, "one") == {"r'1": 2, "r2": 1}
    assert rows(spark.table(hold_table), "serialnumber", "run_dt") == [("c", "r3")]
    assert rows(release.released(spark, path, stage, "one"), "serialnumber", "value") == [("a", 3.0), ("b", 2.0), ("own", 0.0)]
    assert release.release(spark, stage.limit(0), hold_table, path, log, "two") == {"r3": 1}
    assert spark.table(hold_table).count() == 0 and spark.read.parquet(path).count() == 4
    assert release.release(spark, stage.limit(0), hold_table, path, log, "none") == {}


@pytest.mark.parametrize("step", ["_check_listed", "drop_listed", "_enter"])
def test_an_interrupted_release_goes_on_where_it_was(spark, hold_table, monkeypatch, step):
    path, log = scratch_path(spark, "stage"), scratch_path(spark, "manifest")
    stage = spark.createDataFrame([reading("own", "1", 0.0)], HELD)
    release.begin_release(spark, hold_table, log, "one")

    def stop(*_, **__):
        raise Stop

    with monkeypatch.context() as patch, pytest.raises(Stop):
        patch.setattr(release, step, stop)
        release.release(spark, stage, hold_table, path, log, "one")
    release.release(spark, stage, hold_table, path, log, "one")
    assert spark.table(hold_table).count() == 0 and release.state_of(spark, log, "one") == release.DROPPED
    assert rows(spark.read.parquet(path), "serialnumber", "value") == [("a", 3.0), ("b", 2.0), ("own", 0.0)]


def test_a_listed_run_that_changed_is_not_dropped(spark, hold_table):
    path, log = scratch_path(spark, "stage"), scratch_path(spark, "manifest")
    stage = spark.createDataFrame([], HELD)
    release.begin_release(spark, hold_table, log, "one")
    sinks.save_held_table(spark.createDataFrame([reading("z", "1", 1.0)], HELD).withColumn("run_dt", F.lit("r2")), hold_table)
    with pytest.raises(ValueError, match="has changed since it was listed: r2"):
        release.release(spark, stage, hold_table, path, log, "one")
    assert spark.table(hold_table).count() == 4
    assert release.release(spark, stage, hold_table, path, log, "two") == {"r'1": 2, "r2": 2}
    with pytest.raises(ValueError, match="is one of"):
        release.begin_release(spark, "other_table", log, "two")


# --- windows over files ------------------------------------------------------------------

T = [dt.datetime(2024, 1, 1, h) for h in range(6)]


def listed(spark, *files):
    data = [(f"/in/{path}", when, 10) for path, when in files]
    return listing.with_layout(spark.createDataFrame(data, "path string, modificationTime timestamp_ntz, length long"), "/in")


def test_every_file_is_read_once_over_a_changing_listing(spark):
    state = scratch_path(spark, "state")
    first = [("d1/index.txt", T[0]), ("d1/a.xml", T[0]), ("d2/b.xml", T[0])]
    one = control.open_window(spark, listed(spark, *first), state, T[1])
    assert (one.version, one.paths) == (1, ["/in/d1/a.xml"])
    again = control.open_window(spark, listed(spark, *first, ("d1/c.xml", T[0])), state, T[1])  # the first did not finish
    assert again.paths == ["/in/d1/a.xml", "/in/d1/c.xml"]
    control.finish_window(spark, state, again)
    more = [("d1/index.txt", T[2]), ("d1/a.xml", T[0]), ("d1/c.xml", T[2]), ("d1/e.xml", T[2]), ("d2/index.txt", T[2]), ("d2/b.xml", T[0])]
    two = control.open_window(spark, listed(spark, *more), state, T[3])
    assert (two.version, two.start) == (2, T[1])
    assert two.paths == ["/in/d1/c.xml", "/in/d1/e.xml", "/in/d2/b.xml"]  # c.xml was written anew
    control.finish_window(spark, state, two)
    assert control.open_window(spark, listed(spark, *more), state, T[4]).paths == []
    assert rows(control.windows(spark, state), "version", "files", "bytes") == [(1, 2, 20), (2, 3, 30)]
    with pytest.raises(ValueError, match="before the last one did"):
        control.open_window(spark, listed(spark, *more), state, T[2])


def test_of_two_runs_from_the_same_control_value_one_is_refused(spark):
    state, files = scratch_path(spark, "state"), listed(spark, ("d1/index.txt", T[0]), ("d1/a.xml", T[0]))
    one, two = (control.open_window(spark, files, state, T[1]) for _ in range(2))
    control.finish_window(spark, state, one)
    with pytest.raises(RuntimeError, match="but 1 is finished"):
        control.finish_window(spark, state, two)


def test_a_window_moves_on_only_after_success(spark):
    state, files = scratch_path(spark, "state"), listed(spark, ("d1/index.txt", T[0]), ("d1/a.xml", T[0]))
    taken = []

    def process(df, window):
        taken.append(window.paths)
        if len(taken) == 1:
            raise Stop

    read = lambda paths: spark.createDataFrame([(p,) for p in paths], "path string")
    with pytest.raises(Stop):
        control.run_window(spark, files, state, T[1], read, process)
    assert control.windows(spark, state).count() == 0
    control.run_window(spark, files, state, T[1], read, process)
    control.run_window(spark, files, state, T[2], read, process)  # nothing to read, but finished
    assert taken == [["/in/d1/a.xml"]] * 2 and control.windows(spark, state).count() == 2
    with pytest.raises(ValueError, match="more than 0 files"):
        control.open_window(spark, listed(spark, ("d9/index.txt", T[3]), ("d9/z.xml", T[3])), state, T[4], most=0)
