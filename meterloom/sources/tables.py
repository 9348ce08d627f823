"""Parquet and catalog tables, and the unit lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom import spec


def read_parquet(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    return spark.read.parquet(*([paths] if isinstance(paths, str) else paths))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def sample_uom(spark: SparkSession) -> DataFrame:
    rows = [tuple(line.split()) for line in spec.UOM_SAMPLE.strip().splitlines()]
    return spark.createDataFrame(rows, spec.ddl(spec.UOM_COLUMNS))


def uom_lookup(spark: SparkSession, opco: str, table: str | None = None) -> DataFrame:
    """The unit lookup of one operating unit: from the catalog if the table is there, else the
    sample rows. A table that exists but cannot be read is an error, not a reason to fall back."""
    found = table is not None and spark.catalog.tableExists(table)
    rows = read_table(spark, table) if found else sample_uom(spark)
    return rows.filter(F.col("aep_opco") == opco).select(*spec.UOM_COLUMNS).distinct()
