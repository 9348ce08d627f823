"""Nested meter documents to one row per channel reading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom import spec
from meterloom.functions.numbers import number
from meterloom.operators.filters import date_floor, require

_DOCUMENT_NAMES = {
    "_MeterName": "metername",
    "_UtilDeviceID": "utildeviceid",
    "_MacID": "macid",
    "_UtilServicePointID": "utilservicepointid",
}
_BLOCK_NAMES = {
    "_IntervalLength": "intervallength",
    "_StartTime": "blockstarttime",
    "_EndTime": "blockendtime",
    "_NumberIntervals": "numberintervals",
    "Interval": "intervals",
}
_INTERVAL_NAMES = {
    "_EndTime": "int_endtime",
    "_GatewayCollectedTime": "int_gatewaycollectedtime",
    "_BlockSequenceNumber": "int_blocksequencenumber",
    "_IntervalSequenceNumber": "int_intervalsequencenumber",
    "Reading": "readings",
}
_READING_NAMES = {"_Channel": "channel", "_RawValue": "rawvalue", "_Value": "value", "_UOM": "uom"}


def layout(columns: Sequence[str]) -> str:
    """The part of a meter document that these columns of its flattened rows come from, for a
    parser: each attribute of the layout costs time in every document, whether it is used or not.
    All elements stay, as they decide what is left of a document that is broken inside."""
    levels = [("", _DOCUMENT_NAMES), ("IntervalReadData", _BLOCK_NAMES), ("Interval", _INTERVAL_NAMES), ("Reading", _READING_NAMES)]
    unknown = set(columns) - {a for _, names in levels for n, a in names.items() if n.startswith("_")}
    if unknown:
        raise ValueError(f"no attribute of a document gives {', '.join(sorted(unknown))}")
    inner = ""
    for tag, names in reversed(levels):
        own = [f"{n} STRING" for n, a in names.items() if n.startswith("_") and a in columns]
        fields = ", ".join([*own, inner] if inner else own or ["_Channel STRING"])
        inner = f"{tag} ARRAY<STRUCT<{fields}>>" if tag else fields
    return inner


def rename_attributes(documents: DataFrame) -> DataFrame:
    return documents.withColumnsRenamed(_DOCUMENT_NAMES)


def _fields(df: DataFrame, element: str, names: dict[str, str]) -> list[Column]:
    """Those of an element's fields that the documents' layout has, by their flattened names."""
    there = {n.lower() for n in df.schema[element].dataType.fieldNames()}
    made = {"channel": F.trim, "rawvalue": number, "value": number}
    return [made.get(a, F.col)(f"{element}.{n}").alias(a) for n, a in names.items() if n.lower() in there]


def explode_blocks(documents: DataFrame) -> DataFrame:
    """One row per block; documents without blocks disappear."""
    d = rename_attributes(documents)
    carried = [c for c in d.columns if c not in ("IntervalReadData", spec.CORRUPT_COLUMN)]
    blocks = d.select(*carried, F.explode("IntervalReadData").alias("block"))
    return blocks.select(
        *[F.trim("metername").alias(c) if c == "metername" else F.col(c) for c in carried],
        *_fields(blocks, "block", _BLOCK_NAMES),
    )


def explode_intervals(blocks: DataFrame) -> DataFrame:
    """One row per interval; blocks without intervals disappear."""
    carried = [c for c in blocks.columns if c != "intervals"]
    intervals = blocks.select(*carried, F.explode("intervals").alias("i"))
    return intervals.select(*carried, *_fields(intervals, "i", _INTERVAL_NAMES))


def explode_readings(intervals: DataFrame) -> DataFrame:
    """One row per channel reading, numbers parsed; a text that is no number becomes null."""
    carried = [c for c in intervals.columns if c != "readings"]
    readings = intervals.select(*carried, F.explode("readings").alias("r"))
    return readings.select(*carried, *_fields(readings, "r", _READING_NAMES))


def flatten_readings(
    documents: DataFrame,
    required: tuple[str, ...] = ("channel", "rawvalue", "value", "uom"),
    block_floor: str | None = None,
) -> DataFrame:
    """Documents to complete readings.

    ``block_floor`` drops blocks that start before a date ahead of the two later explodes, so
    old blocks never multiply.
    """
    blocks = explode_blocks(documents)
    if block_floor is not None:
        blocks = date_floor(blocks, "blockstarttime", block_floor)
    return require(explode_readings(explode_intervals(blocks)), required)
