"""Keep the latest version of each key, with a total order so that reruns agree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from meterloom.functions.times import end_epoch


def _order(df: DataFrame, keys: Sequence[str], order: Sequence[str], tie_break: Sequence[str] | None) -> list[str]:
    """The order columns followed by what breaks ties: by default every other column."""
    rest = df.columns if tie_break is None else tie_break
    return [*order, *[c for c in rest if c not in keys and c not in order]]


def _newest_first(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def keep_latest(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], tie_break: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the greatest by ``order``, then by the tie-break columns.

    Spark limits each group to one row before the shuffle, so many copies of one key cost one
    row per map task and not one reducer that takes them all.
    """
    newest = Window.partitionBy(*keys).orderBy(*_newest_first(_order(df, keys, order, tie_break)))
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def keep_latest_collected(df: DataFrame, keys: Sequence[str], column: str = "int_gatewaycollectedtime") -> DataFrame:
    """One row per key: the one collected last, by the instant its text names. Texts with
    different offsets are compared as times; equal instants by the text, then as above."""
    instant = df.withColumn("_instant", end_epoch(column))
    return keep_latest(instant, keys, ["_instant", column]).drop("_instant")


def keep_latest_agg(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], tie_break: Sequence[str] | None = None
) -> DataFrame:
    """The same rows by ``max_by`` instead of a window; partial maxima form before the shuffle."""
    ranked = _order(df, keys, order, tie_break)
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*ranked)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*").select(*df.columns)


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and surplus rows. Counts per key are formed first, before and after
    the shuffle, so no key is expanded. Null is a key value like any other, as it is for
    ``keep_latest``."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
    )
