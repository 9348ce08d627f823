"""The wide delimited feed, brought to the shape of the nested one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom import spec
from meterloom.functions.numbers import number
from meterloom.operators import enrich
from meterloom.sources.wide import wide_to_long


def wide_source_view(
    wide: DataFrame,
    uom: DataFrame,
    n_pairs: int = spec.WIDE_PAIRS,
    channel_col: str = "purpose",
    floor: str = spec.DATE_FLOOR,
    zone: str = spec.DEFAULT_ZONE,
    target_zone: str | None = None,
    **bounds,
) -> DataFrame:
    """One row per filled pair with times and units, as ``source_view`` gives for documents.

    The feed states its interval in seconds; the length is carried in minutes like elsewhere.
    """
    rows = wide_to_long(wide, n_pairs, zone=zone, target_zone=target_zone, floor=floor)
    shaped = rows.select(
        F.trim("meter_id").alias("metername"),
        F.col("esiid").alias("utildeviceid"),
        (number("cinterval", "int") / 60).cast("int").cast("string").alias("intervallength"),
        "position",
        "interval_note",
        "starttime",
        "endtime",
        "interval_epoch",
        "unix_endtime",
        F.trim(channel_col).alias("channel"),
        "value",
        F.col("units").alias("uom"),
    )
    return enrich.uom_join(shaped, uom, **bounds)
