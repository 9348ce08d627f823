"""Release of held rows in two phases: what is listed is what is released and what is dropped.

A release lists the run partitions of the hold table once, with their rows, and enters them in a
manifest. The released rows are read from these partitions alone and written to the stage under
the release's own partition, which a second run replaces. Only if the listed partitions hold as
many rows as were listed, before they are read and again after the stage is written, are they
dropped. A run held in the meantime is in none of the lists: it stays for the next release.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom import spec
from meterloom.operators.hold import hold_release
from meterloom.sinks.tables import drop_listed, read_or_empty

LISTED, STAGED, DROPPED = "listed", "staged", "dropped"
STATES = (LISTED, STAGED, DROPPED)
MANIFEST = "release_id string, state string, hold_table string, run_dt string, row_count long, at timestamp"
RUN, RELEASE = "run_dt", "release_id"


def entries(spark: SparkSession, manifest: str, release_id: str | None = None) -> DataFrame:
    found = read_or_empty(spark, manifest, MANIFEST)
    return found if release_id is None else found.filter(F.col(RELEASE) == release_id)


def state_of(spark: SparkSession, manifest: str, release_id: str) -> str | None:
    """How far a release has come; None if it was never begun."""
    seen = {r[0] for r in entries(spark, manifest, release_id).select("state").distinct().collect()}
    return max(seen, key=STATES.index, default=None)


def listed(spark: SparkSession, manifest: str, release_id: str) -> dict[str, int]:
    """Run days of a release and the rows that each had when it was listed."""
    rows = entries(spark, manifest, release_id).filter((F.col("state") == LISTED) & F.col(RUN).isNotNull())
    return {r[RUN]: r["row_count"] for r in rows.select(RUN, "row_count").collect()}


def _enter(spark: SparkSession, manifest: str, rows: list[tuple]) -> None:
    """Rows of one state at once: one file, so that none of them is seen without the others."""
    frame = spark.createDataFrame(rows, "release_id string, state string, hold_table string, run_dt string, row_count long")
    frame.coalesce(1).withColumn("at", F.current_timestamp()).write.mode("append").parquet(manifest)


def begin_release(spark: SparkSession, hold_table: str, manifest: str, release_id: str) -> dict[str, int]:
    """List the hold table's run days and their rows in the manifest. A release that was begun
    before keeps its list; one of another table by the same name is refused."""
    other = entries(spark, manifest, release_id).filter(F.col("hold_table") != hold_table)
    if not other.isEmpty():
        raise ValueError(f"release {release_id} is one of {other.first()['hold_table']}")
    if state_of(spark, manifest, release_id) is None:
        found = spark.table(hold_table).groupBy(RUN).count().filter(F.col(RUN).isNotNull()).collect()
        # A row without a run day keeps the list of an empty hold from looking like no list.
        rows = [(release_id, LISTED, hold_table, r[RUN], r["count"]) for r in found]
        _enter(spark, manifest, [*rows, (release_id, LISTED, hold_table, None, 0)])
    return listed(spark, manifest, release_id)


def _held(spark: SparkSession, hold_table: str, runs: Sequence[str]) -> DataFrame:
    held = spark.table(hold_table)
    return held.filter(F.col(RUN).isin(list(runs))) if runs else held.limit(0)


def _check_listed(spark: SparkSession, hold_table: str, runs: dict[str, int]) -> None:
    now = {r[RUN]: r["count"] for r in _held(spark, hold_table, list(runs)).groupBy(RUN).count().collect()}
    changed = sorted(run for run, rows in runs.items() if now.get(run, 0) != rows)
    if changed:
        raise ValueError(f"{hold_table} has changed since it was listed: {', '.join(changed)}")


def release(
    spark: SparkSession,
    stage: DataFrame,
    hold_table: str,
    stage_path: str,
    manifest: str,
    release_id: str,
    keys: Sequence[str] = tuple(spec.READING_KEYS),
    order: Sequence[str] | None = None,
) -> dict[str, int]:
    """The stage's own rows and the latest version of each held reading, appended to ``stage_path``
    once; then the released run days are dropped from the hold table. Returns them with their rows.

    A release that was interrupted goes on where it was: its list is not made anew, its rows in
    the stage are replaced rather than added, and what was dropped is not looked for again. If a
    listed run day has other rows than when it was listed, the release fails and drops nothing; a
    new one then lists the new rows.
    """
    runs = begin_release(spark, hold_table, manifest, release_id)
    state = state_of(spark, manifest, release_id)
    if state == LISTED:
        _check_listed(spark, hold_table, runs)
        rows = hold_release(stage, _held(spark, hold_table, list(runs)), keys, order)
        staged = rows.withColumn(RELEASE, F.lit(release_id))
        staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RELEASE).parquet(stage_path)
        written = released(spark, stage_path, stage, release_id).count()
        _enter(spark, manifest, [(release_id, STAGED, hold_table, None, written)])
        state = STAGED
    if state == STAGED:
        still = {r[0] for r in _held(spark, hold_table, list(runs)).select(RUN).distinct().collect()}
        if still:  # dropping is one statement; after it there is nothing left to compare
            _check_listed(spark, hold_table, {run: rows for run, rows in runs.items() if run in still})
            drop_listed(spark, hold_table, [{RUN: run} for run in sorted(still)])
        _enter(spark, manifest, [(release_id, DROPPED, hold_table, None, sum(runs.values()))])
    return runs


def released(spark: SparkSession, stage_path: str, layout: DataFrame, release_id: str) -> DataFrame:
    """The rows that one release has put into the stage; none if there was no such release."""
    return read_or_empty(spark, f"{stage_path}/{RELEASE}={release_id}", layout.schema)
