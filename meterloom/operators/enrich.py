"""Enrichment by the unit lookup and by the validity-windowed assignments."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom import spec
from meterloom.functions.text import delivery_id, or_unknown, raw_unit, register_name
from meterloom.functions.times import from_zone, wall_seconds
from meterloom.operators import joins
from meterloom.operators.dedup import keep_latest
from meterloom.operators.filters import company_filter
from meterloom.session import stage_once

# Names under which an assignment's columns appear next to a reading.
ASSIGNMENT_OUTPUT = {
    "prem_nb": "aep_premise_nb",
    "bill_cnst": "bill_cnst",
    "acct_clas_cd": "aep_acct_cls_cd",
    "acct_type_cd": "aep_acct_type_cd",
    "devc_cd": "aep_devicecode",
    "pgm_id_nm": "aep_meter_program",
    "sd": "aep_srvc_dlvry_id",
    "mtr_pnt_nb": "aep_mtr_pnt_nb",
    "tarf_pnt_nb": "aep_tarf_pnt_nb",
    "mtr_rmvl_ts": "aep_mtr_removal_ts",
    "mtr_inst_ts": "aep_mtr_install_ts",
    "serv_city_ad": "aep_city",
    "serv_zip_ad": "aep_zip",
    "state_cd": "aep_state",
}
BOUNDS = ("unix_mtr_inst_ts", "unix_mtr_rmvl_ts", "unix_acct_turn_on_dt", "unix_acct_turn_off_dt")


def lookup_conflicts(uom: DataFrame) -> DataFrame:
    """Channels that the lookup defines more than once, with the number of definitions."""
    return (
        uom.distinct()
        .groupBy("aep_opco", "aep_channel_id")
        .agg(F.count(F.lit(1)).alias("definitions"))
        .filter("definitions > 1")
    )


def uom_join(
    df: DataFrame, uom: DataFrame, opco: str | None = None, default: str = spec.UNKNOWN, **bounds
) -> DataFrame:
    """Left join on the channel; readings on an unlisted channel get ``default``.

    Adds ``aep_uom``, ``name_register``, ``aep_sqi`` and ``value_mltplr_flg`` and trims and
    lowers ``uom``.
    """
    wanted = uom if opco is None else uom.filter(F.col("aep_opco") == opco)
    lookup = wanted.select(
        F.col("aep_channel_id").alias("u_channel"),
        F.col("aep_derived_uom").alias("u_uom"),
        F.col("aep_raw_uom").alias("u_raw"),
        F.col("name_register").alias("u_register"),
        F.col("aep_srvc_qlty_idntfr").alias("u_sqi"),
        F.col("value_mltplr_flg").alias("u_flag"),
    ).distinct()
    keyed = df.withColumn("channel", F.col("channel").cast("string"))
    spread = [c for c in ("metername", "int_endtime", "endtime") if c in df.columns]
    joined = joins.lookup_join(keyed, lookup, {"channel": "u_channel"}, spread, **bounds)
    return joined.select(
        *[c for c in keyed.columns if c != "uom"],
        raw_unit("uom").alias("uom"),
        or_unknown("u_uom", default).alias("aep_uom"),
        register_name("u_register", "intervallength", default).alias("name_register"),
        or_unknown("u_sqi", default).alias("aep_sqi"),
        F.col("u_flag").alias("value_mltplr_flg"),
    )


def validity_bounds(
    assignments: DataFrame, opco: str | None = None, zone: str = spec.DEFAULT_ZONE
) -> DataFrame:
    """Assignments with their four bounds as epoch seconds and the joined delivery id.

    The bounds are texts in one of the three source forms and are read in ``zone``; what
    fits none of them is null, and a null bound matches no reading.
    """
    owned = assignments if opco is None else company_filter(assignments, opco)
    return owned.select(
        "*",
        delivery_id("tx_mand_data", "doe_nb", "serv_deliv_id").alias("sd"),
        *[
            from_zone(wall_seconds(name.removeprefix("unix_")), zone).alias(name)
            for name in BOUNDS
        ],
    )


def valid_within(bounded: DataFrame, readings: DataFrame) -> DataFrame:
    """Those of the assignments that hold at some time between the first and the last end of
    ``readings``; no other can match one of these."""
    ends = readings.agg(F.min("unix_endtime").alias("first"), F.max("unix_endtime").alias("last")).first()
    kind = readings.schema["unix_endtime"].dataType
    starts = (F.col(b) <= F.lit(ends["last"]).cast(kind) for b in BOUNDS[::2])
    stops = (F.col(b) >= F.lit(ends["first"]).cast(kind) for b in BOUNDS[1::2])
    return bounded.filter(reduce(lambda a, b: a & b, [*starts, *stops]))


def assignment_join(
    df: DataFrame,
    bounded: DataFrame,
    pick: str | None = None,
    keys: Sequence[str] = ("metername", "endtime", "channel", "uom"),
    how: str = "left",
    binned: bool = False,
    **bounds,
) -> DataFrame:
    """Readings joined to the assignments valid at their end, both ends included.

    ``df`` has ``metername`` and ``unix_endtime``; ``bounded`` comes from ``validity_bounds``.
    A reading covered by two assignments yields two rows, unless ``pick="latest"``, which
    leaves one row per reading key: the one with the latest install time.

    A reading is compared with all assignments of its meter. ``binned=True`` is for meters with
    very many of them: it enters each assignment in the cells of time that it covers and compares
    a reading with those of its own cells (see ``binned_join``); the rows are the same.
    """
    lookup = bounded.select(
        F.col("mfr_devc_ser_nbr").alias("a_serial"),
        *BOUNDS,
        *[F.col(source).alias(f"a_{source}") for source in ASSIGNMENT_OUTPUT],
    )
    at = F.col("unix_endtime")
    valid = at.between(F.col(BOUNDS[0]), F.col(BOUNDS[1])) & at.between(F.col(BOUNDS[2]), F.col(BOUNDS[3]))
    spread = [k for k in keys if k != "metername"]
    if binned:
        joined = _binned(df, lookup, spread, how, **bounds)
    else:
        joined = joins.lookup_join(
            df, lookup, {"metername": "a_serial"}, spread, how=how, residual=valid, **bounds
        )
    if how == "left_anti":
        return joined.select(*df.columns)
    added = [F.col(f"a_{s}").alias(o) for s, o in ASSIGNMENT_OUTPUT.items()]
    if pick is None:
        return joined.select(*df.columns, *added)
    if pick != "latest":
        raise ValueError(f"pick is None or 'latest', not {pick!r}")
    rows = joined.select(*df.columns, "unix_mtr_inst_ts", *added)
    return keep_latest(rows, list(keys), ["unix_mtr_inst_ts"]).drop("unix_mtr_inst_ts")


def _binned(df: DataFrame, lookup: DataFrame, spread: Sequence[str], how: str, **bounds) -> DataFrame:
    """As the join of readings with all assignments of their meter, by cells. A reading without a
    match is one that no pair names, by a number of its own."""
    numbered = stage_once(df.withColumn("_reading", F.monotonically_increasing_id()), "readings")
    narrow = lookup.withColumns(
        {"_first": F.greatest(BOUNDS[0], BOUNDS[2]), "_last": F.least(BOUNDS[1], BOUNDS[3])}
    ).dropna(subset=list(BOUNDS))
    found = joins.binned_join(
        numbered, narrow, {"metername": "a_serial"}, "unix_endtime", ("_first", "_last"), ["_reading", *spread], **bounds
    ).drop("_first", "_last")
    if how == "inner":
        return found.drop("_reading")
    found = stage_once(found, "matched")
    rest = numbered.join(found.select(F.col("_reading").alias("_known")).distinct(), F.col("_reading") == F.col("_known"), "left_anti")
    if how == "left_anti":
        return rest.drop("_reading")
    if how != "left":
        raise ValueError(f"how is left, inner or left_anti, not {how!r}")
    return found.unionByName(rest, allowMissingColumns=True).drop("_reading")


def unmatched_readings(df: DataFrame, bounded: DataFrame, uom: DataFrame, **bounds) -> DataFrame:
    """Readings that no assignment covers or whose channel the lookup does not list, each with
    the reason; a reading that misses both appears once per reason."""
    no_assignment = assignment_join(df, bounded, how="left_anti", **bounds)
    listed = uom.select(F.col("aep_channel_id").alias("u_channel")).distinct()
    spread = [c for c in ("metername", "int_endtime", "endtime") if c in df.columns]
    no_unit = joins.lookup_join(df, listed, {"channel": "u_channel"}, spread, how="left_anti", **bounds)
    return no_assignment.withColumn("reason", F.lit("assignment")).unionByName(
        no_unit.select(*df.columns).withColumn("reason", F.lit("unit"))
    )
