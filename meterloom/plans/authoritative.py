"""The second feed: fewer required columns, strict floor, no assignment join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom import spec
from meterloom.functions.text import first_chars, meter_bucket
from meterloom.operators import enrich
from meterloom.operators.flatten import flatten_readings
from meterloom.operators.times import interval_times

REQUIRED = ("channel", "value", "uom")


def auth_stage(
    documents: DataFrame,
    uom: DataFrame,
    opco: str,
    floor: str = spec.DATE_FLOOR_STRICT,
    zone: str = spec.DEFAULT_ZONE,
    **bounds,
) -> DataFrame:
    """Readings in the 14-column stage layout. Here the raw value is the register count, and it
    may be missing."""
    timed = interval_times(flatten_readings(documents, REQUIRED), zone=zone, floor=floor, inclusive=False)
    joined = enrich.uom_join(timed, uom, **bounds)
    columns = {
        "serialnumber": F.col("metername"),
        "starttimeperiod": F.col("starttime"),
        "endtimeperiod": F.col("endtime"),
        "aep_raw_uom": F.col("uom"),
        "aep_raw_value": F.col("rawvalue"),
        "aep_opco": F.lit(opco),
        "aep_channel_id": F.col("channel"),
        "aep_usage_dt": first_chars("starttime", 10),
        "aep_derived_uom": F.col("aep_uom"),
        "aep_meter_bucket": meter_bucket("metername"),
    }
    return joined.select(*[columns.get(c, F.col(c)).alias(c) for c in spec.AUTH_STAGE_COLUMNS])
