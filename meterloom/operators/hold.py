"""Hold late rows during the week, release them on the release day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom import spec
from meterloom.functions.times import run_stamp_day_name
from meterloom.operators.dedup import keep_latest, keep_latest_collected

LABEL = "hold_label"


def cut_off(anchor: dt.date | None, days: int) -> Column:
    """ISO text of the day ``days`` before ``anchor`` (today, if none). A literal either way
    by the time the scan is planned, so comparisons with it are pushed down."""
    if anchor is not None:
        return F.lit((anchor - dt.timedelta(days=days)).isoformat())
    return F.date_format(F.date_sub(F.current_date(), days), "yyyy-MM-dd")


def hold_split(
    df: DataFrame,
    date_col: str = "aep_usage_dt",
    anchor: dt.date | None = None,
    keep_days: int = spec.KEEP_DAYS,
    hold_days: int = spec.HOLD_DAYS,
) -> DataFrame:
    """Adds ``hold_label``: keep, hold, expired (older than the hold) or undated.

    Only the first two go on; the other two are labelled so that they can be counted.
    """
    day = F.col(date_col)
    label = (
        F.when(day.isNull(), "undated")
        .when(day >= cut_off(anchor, keep_days), "keep")
        .when(day >= cut_off(anchor, hold_days), "hold")
        .otherwise("expired")
    )
    return df.withColumn(LABEL, label)


def kept(df: DataFrame, date_col: str = "aep_usage_dt", anchor=None, keep_days: int = spec.KEEP_DAYS) -> DataFrame:
    return df.filter(F.col(date_col) >= cut_off(anchor, keep_days))


def held(
    df: DataFrame,
    run_dt: str | None = None,
    date_col: str = "aep_usage_dt",
    anchor: dt.date | None = None,
    keep_days: int = spec.KEEP_DAYS,
    hold_days: int = spec.HOLD_DAYS,
) -> DataFrame:
    """Rows to hold, labelled with the run day (``yyyyMMdd``)."""
    day = F.col(date_col)
    rows = df.filter((day >= cut_off(anchor, hold_days)) & (day < cut_off(anchor, keep_days)))
    if run_dt is not None:
        label = F.lit(run_dt)
    elif anchor is not None:
        label = F.lit(anchor.strftime("%Y%m%d"))
    else:
        label = F.date_format(F.current_date(), "yyyyMMdd")
    return rows.withColumn("run_dt", label)


def hold_release(
    stage: DataFrame,
    held_rows: DataFrame,
    keys: Sequence[str] = tuple(spec.READING_KEYS),
    order: Sequence[str] | None = None,
) -> DataFrame:
    """The stage plus the latest version of each held reading, matched by column name. The
    latest is the one collected last, unless other ``order`` columns are given."""
    rows = held_rows.drop("run_dt")
    released = keep_latest_collected(rows, keys) if order is None else keep_latest(rows, keys, order)
    return stage.unionByName(released)


def hold_audit(held_rows: DataFrame, date_col: str = "aep_usage_dt") -> DataFrame:
    return (
        held_rows.groupBy("run_dt", date_col)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy("run_dt", date_col)
    )


def release_day(df: DataFrame, stamp_col: str = "run_stamp", opco_col: str = "aep_opco") -> DataFrame:
    """Adds ``day_name`` and ``is_release_day`` for a run stamp and operating unit."""
    named = df.withColumn("day_name", run_stamp_day_name(stamp_col))
    rule = F.lit(False)
    for day, units in spec.RELEASE_DAYS.items():
        rule = rule | ((F.col("day_name") == day) & F.col(opco_col).isin(units))
    return named.withColumn("is_release_day", F.coalesce(rule, F.lit(False)))
