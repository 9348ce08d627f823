"""Wide delimited feed: one line per meter and day, up to 100 (t, v) pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom import spec
from meterloom.functions import times as t
from meterloom.functions.numbers import number
from meterloom.operators.times import from_floor


def read_wide_text(
    spark: SparkSession, paths: Sequence[str] | str, n_pairs: int = spec.WIDE_PAIRS, sep: str = "~"
) -> DataFrame:
    """Delimited lines as text columns, with the file they came from; empty fields are null."""
    listed = [paths] if isinstance(paths, str) else list(paths)
    return (
        spark.read.schema(spec.wide_schema(n_pairs))
        .csv(listed, sep=sep, quote='"', escape="\\", nullValue="", emptyValue="")
        .withColumn("filename", F.col("_metadata.file_path"))
    )


def wide_values_array(df: DataFrame, n_pairs: int = spec.WIDE_PAIRS) -> DataFrame:
    """The ``v`` columns as one array; a gap stays a null at its own position."""
    values = F.array(*[F.col(f"v{i}") for i in range(1, n_pairs + 1)])
    seconds = number("cinterval", "int")
    return df.withColumns(
        {
            "value": values,
            "intervallength": seconds.cast("string"),
            "aep_sec_per_intrvl": seconds,
        }
    )


def wide_to_long(
    df: DataFrame,
    n_pairs: int = spec.WIDE_PAIRS,
    length_col: str = "cinterval",
    first_col: str = "firstintervaldatetime",
    zone: str = spec.DEFAULT_ZONE,
    target_zone: str | None = None,
    drop_gaps: bool = True,
    floor: str | None = None,
) -> DataFrame:
    """One row per filled pair, with its position and times.

    The first time is a wall-clock time in ``zone``; interval n starts n lengths (seconds) after
    it, counted on the instant, and is shown in ``target_zone`` (default: ``zone``). ``floor``
    keeps the rows whose start day there is on or after a date.
    """
    shown = target_zone or zone
    pairs = F.array(
        *[F.struct(F.col(f"t{i}").alias("t"), F.col(f"v{i}").alias("v")) for i in range(1, n_pairs + 1)]
    )
    paired = {f"{side}{i}" for i in range(1, n_pairs + 1) for side in ("t", "v")}
    carried = [c for c in df.columns if c not in paired]
    rows = (
        df.withColumn("_first", t.from_zone(t.first_interval_wall(first_col), zone))
        .select(*carried, "_first", F.posexplode(pairs).alias("position", "pair"))
        .withColumn("seconds", number(length_col, "int"))
        .withColumn("value", number("pair.v"))
    )
    if drop_gaps:
        rows = rows.filter(F.col("value").isNotNull())
    rows = rows.withColumn("unix_start", F.col("_first") + F.col("position") * F.col("seconds"))
    rows = rows.withColumn("unix_endtime", F.col("unix_start") + F.col("seconds"))
    rows = rows.withColumns(
        {"_start": t.to_zone("unix_start", shown), "_end": t.to_zone("unix_endtime", shown)}
    ).filter(from_floor("_start", floor))
    rows = rows.withColumn("interval_epoch", t.offset_text(F.col("_end") - F.col("unix_endtime")))
    start_offset = t.offset_text(F.col("_start") - F.col("unix_start"))
    return rows.select(
        *carried,
        (F.col("position") + 1).alias("position"),
        F.col("pair.t").alias("interval_note"),
        "value",
        F.concat(t.wall_text("_start"), start_offset).alias("starttime"),
        F.concat(t.wall_text("_end"), "interval_epoch").alias("endtime"),
        "interval_epoch",
        "unix_endtime",
    )
