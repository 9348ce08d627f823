"""From nested meter documents to rows for the target table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom import spec
from meterloom.operators import audit, conform, dedup, enrich
from meterloom.operators.flatten import flatten_readings
from meterloom.operators.times import interval_times

REQUIRED = ("channel", "rawvalue", "value", "uom")
_KEYS = ("metername", "endtime", "channel", "uom")
_COLLECTED = "int_gatewaycollectedtime"


def source_view(
    documents: DataFrame,
    uom: DataFrame,
    floor: str | None = spec.DATE_FLOOR,
    zone: str = spec.DEFAULT_ZONE,
    **bounds,
) -> DataFrame:
    """Complete readings with times and units whose start is on or after the floor."""
    timed = interval_times(flatten_readings(documents, REQUIRED), zone=zone, floor=floor)
    return enrich.uom_join(timed, uom, **bounds)


def stage_rows(source: DataFrame, bounded: DataFrame, opco: str, pick: str | None = None, **bounds) -> DataFrame:
    return conform.stage(enrich.assignment_join(source, bounded, pick, **bounds), opco)


def stage_view(
    source: DataFrame, bounded: DataFrame, opco: str, now: Column | None = None, pick: str | None = None, **bounds
) -> DataFrame:
    return conform.stage_view(stage_rows(source, bounded, opco, pick, **bounds), now)


def consume_view(
    source: DataFrame, bounded: DataFrame, opco: str, now: Column | None = None, **bounds
) -> DataFrame:
    """The latest version of each reading in the target layout.

    A reading's key consists of columns it has before the assignment join, so versions are
    reduced first. The join then moves each key once, no group of copies reaches it, and only
    overlapping assignments are left to choose from.
    """
    latest = dedup.keep_latest_collected(source, _KEYS, _COLLECTED)
    return conform.consume(stage_view(latest, bounded, opco, now, pick="latest", **bounds))


def stage_counts(
    documents: DataFrame, uom: DataFrame, bounded: DataFrame, opco: str, floor: str = spec.DATE_FLOOR,
    zone: str = spec.DEFAULT_ZONE, **bounds,
) -> DataFrame:
    """Rows after each step, as ``(step, row_count)``.

    Three aggregates instead of one recomputation per step: array sizes of the documents,
    readings before and after the floor, staged rows and their distinct keys. The counts are
    part of the plan, so they stay exact when tasks are run again.
    """
    docs = audit.document_counts(documents, REQUIRED)
    readings = source_view(documents, uom, None, zone, **bounds).agg(
        F.count(F.lit(1)).alias("unit_joined"),
        F.count_if(F.col("starttime") >= floor).alias("after_date_floor"),
    )
    source = source_view(documents, uom, floor, zone, **bounds)
    staged = conform.conform(stage_view(source, bounded, opco, **bounds))
    rows = dedup.duplicate_count(staged, spec.READING_KEYS).withColumnsRenamed(
        {"row_count": "staged", "distinct_keys": "latest", "duplicates": "duplicates_removed"}
    )

    def long(df: DataFrame) -> DataFrame:
        return df.unpivot([], df.columns, "step", "row_count")

    return audit.union_all([long(docs), long(readings), long(rows)])
