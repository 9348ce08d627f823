"""Versions of a lookup in time, so that a late reading meets the rows that held at its end.

Each state of a lookup is entered with the day from which it holds. A row that stays is one version
for all of that time; one that goes is closed on the day, one that comes is opened on it. Versions
cover half-open ranges of days, [valid_from, valid_to). No key is needed: what is tracked
is whole rows, so a key may have many of them, or be null, and a changed row is one that goes and
one that comes. Running an old day again after the lookup has changed gives the old day's rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterloom.operators.joins import lookup_join
from meterloom.sinks.tables import read_or_empty

FROM, TO = "valid_from", "valid_to"
ENTRIES = "day date, path string, layout string, version long"


def advance(versions: DataFrame, snapshot: DataFrame, day: dt.date) -> DataFrame:
    """The versions after ``snapshot``, which holds from ``day`` on; no version may begin later.

    One aggregate over open versions and snapshot, in which nulls are equal; repeated rows of the
    snapshot are one version. Closed versions are passed through. What was opened on the same day
    and is missing now never held and leaves no version.
    """
    columns = snapshot.columns
    known = versions.filter(F.col(TO).isNull()).select(*columns, FROM, F.lit(True).alias("_was"))
    now = snapshot.select(*columns, F.lit(None).cast("date").alias(FROM), F.lit(False).alias("_was"))
    since = F.when(F.bool_or("_was"), F.min(FROM)).otherwise(F.lit(day)).alias(FROM)
    until = F.when(F.bool_and("_was"), F.lit(day)).alias(TO)
    current = known.unionByName(now).groupBy(*columns).agg(since, until)
    held = current.filter(F.col(TO).isNull() | F.col(FROM).isNull() | (F.col(FROM) < F.col(TO)))
    return versions.filter(F.col(TO).isNotNull()).select(*columns, FROM, TO).unionByName(held)


def _newest(spark: SparkSession, state: str):
    rows = read_or_empty(spark, f"{state}/entries", ENTRIES)
    return rows.agg(F.max_by(F.struct(*rows.columns), "version").alias("e")).first()["e"]


def read_versions(spark: SparkSession, state: str) -> DataFrame:
    """The stored versions of a lookup."""
    entry = _newest(spark, state)
    if entry is None:
        raise ValueError(f"no state of a lookup was entered in {state}")
    return spark.read.schema(StructType.fromDDL(entry["layout"])).parquet(entry["path"])


def enter(spark: SparkSession, state: str, snapshot: DataFrame, day: dt.date) -> DataFrame:
    """Enter the state of a lookup that holds from ``day`` on; returns all versions.

    The first state's rows are taken to hold since ever (``valid_from`` null). Days go forward: an
    earlier one is refused, the same one may be entered again, with the same or with corrected
    rows. All columns must be those of the states before. The versions are written to a
    folder of their own; the entry that names it is a compare and set, so a run that is cut off
    changes nothing, and a second writer is refused.
    """
    if {FROM, TO} & set(snapshot.columns):
        raise ValueError(f"a lookup has no columns {FROM} and {TO} of its own")
    entry = _newest(spark, state)
    version = entry["version"] + 1 if entry else 1
    forever = F.lit(None).cast("date")
    if entry is None:
        after = snapshot.distinct().withColumns({FROM: forever, TO: forever})
    else:
        before = read_versions(spark, state)
        if sorted(snapshot.columns) != sorted(c for c in before.columns if c not in (FROM, TO)):
            raise ValueError("the lookup's columns are not those of the state before")
        if day < entry["day"]:
            raise ValueError(f"{day} lies before {entry['day']}, which was entered already")
        kinds = [F.col(f.name).cast(f.dataType).alias(f.name) for f in before.schema if f.name not in (FROM, TO)]
        after = advance(before, snapshot.select(*kinds), day)
    path = f"{state}/rows/{uuid4().hex}"
    after.write.parquet(path)
    layout = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in after.schema)
    row = spark.createDataFrame([(day, path, layout)], ENTRIES.rsplit(",", 1)[0])
    try:
        row.coalesce(1).write.mode("errorifexists").parquet(f"{state}/entries/version={version}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_ALREADY_EXISTS":
            raise
        raise RuntimeError(f"version {version} was written by another run") from error
    return read_versions(spark, state)


def holds(day: Column) -> Column:
    """Whether a version holds on ``day``."""
    return (F.col(FROM).isNull() | (day >= F.col(FROM))) & (F.col(TO).isNull() | (day < F.col(TO)))


def as_of(versions: DataFrame, day: dt.date) -> DataFrame:
    """The lookup as it was on a day."""
    return versions.filter(holds(F.lit(day))).drop(FROM, TO)


def join_as_of(
    df: DataFrame, versions: DataFrame, keys: dict[str, str], day: str, spread: Sequence[str], how: str = "left", **bounds
) -> DataFrame:
    """``df`` joined to the versions that hold on the day in its column ``day``.

    ``keys`` and ``spread`` are those of ``lookup_join``, which measures the versions before it
    broadcasts them and salts the join beyond that. A row without a day meets only versions that
    are open on both sides.
    """
    met = F.coalesce(holds(F.col(day)), F.lit(False))
    return lookup_join(df, versions, keys, spread, how=how, residual=met, **bounds).drop(FROM, TO)
