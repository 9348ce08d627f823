"""A feed's structure, kept in versions, so that feeds whose documents differ are read as one.

Each delivery's structure is found on its own and merged into the stored one; later deliveries are
read by what is stored, without a second pass over files that were looked at before. A version
is a folder with one row: the feed that led to it, the merged structure and what changed.
Versions are written by compare and set: a second writer of the same version is refused.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterloom import spec
from meterloom.sinks.tables import read_or_empty
from meterloom.sources import xml

CHANGE = "path string, change string, before string, after string"
VERSIONS = f"feed string, structure string, changes array<struct<{CHANGE.replace(' string', ':string')}>>, version long"
#: Columns of a scan that are not part of a document.
ADDED = ("filename", spec.CORRUPT_COLUMN)
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMBERS = (*_WHOLE, T.FloatType, T.DoubleType, T.DecimalType)


@dataclass(frozen=True)
class Structure:
    """A stored version; ``changes`` is how the last delivery differed from the one before."""

    version: int
    schema: T.StructType
    changes: list[tuple[str, str, str | None, str | None]] = field(default_factory=list)


def widest(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds both. One element and several of it are several. Text and a group of
    fields are the group with a field for the text. Whole numbers are the larger of the two, other
    numbers are doubles, and whatever else differs is text."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.ArrayType) or isinstance(b, T.ArrayType):
        one, other = (t.elementType if isinstance(t, T.ArrayType) else t for t in (a, b))
        return T.ArrayType(widest(one, other))
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return union(a, b)
    if isinstance(a, T.StructType):
        return union(a, T.StructType().add(xml.VALUE_TAG, b))
    if isinstance(b, T.StructType):
        return union(T.StructType().add(xml.VALUE_TAG, a), b)
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    if isinstance(a, _NUMBERS) and isinstance(b, _NUMBERS):
        return T.DoubleType()
    return T.StringType()


def union(a: T.StructType, b: T.StructType) -> T.StructType:
    """The fields of both, those of ``a`` first and in its order. Names that differ in case only
    are refused, since a query could not tell them apart."""
    fields = {f.name: f.dataType for f in a}
    for f in b:
        fields[f.name] = widest(fields[f.name], f.dataType) if f.name in fields else f.dataType
    if len({name.lower() for name in fields}) < len(fields):
        raise ValueError(f"names that differ in case only among {', '.join(fields)}")
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _kinds(kind: T.DataType, path: str = "") -> Iterator[tuple[str, str]]:
    label = ""
    while isinstance(kind, T.ArrayType):
        label, kind = label + "array of ", kind.elementType
    group = isinstance(kind, T.StructType)
    if path:
        yield path, label + ("fields" if group else kind.simpleString())
    for f in kind if group else ():
        yield from _kinds(f.dataType, f"{path}/{f.name}")


def changes(stored: T.StructType, found: T.StructType) -> list[tuple[str, str, str | None, str | None]]:
    """How a delivery differs from what is stored, by path: fields that are new, that it lacks
    (absent), or that need a wider type than the stored one (widened)."""
    before, seen, after = (dict(_kinds(s)) for s in (stored, found, union(stored, found)))
    listed = []
    for path, kind in after.items():
        if path not in before:
            listed.append((path, "new", None, kind))
        elif kind != before[path]:
            listed.append((path, "widened", before[path], kind))
        elif path not in seen:
            listed.append((path, "absent", kind, kind))
    return listed


def infer(spark: SparkSession, paths: Sequence[str] | str, row_tag: str = spec.ROW_TAG, share: float | None = None) -> T.StructType:
    """The structure of a delivery, with text leaves; of a share of its documents if one is given.
    What the share misses is not lost to the feed: it is found when a later delivery holds it, and
    a scan by the stored structure leaves it out until then."""
    found = xml.read_meter_xml(spark, paths, row_tag, infer=True, share=share).schema
    return T.StructType([f for f in found if f.name not in ADDED])


def versions(spark: SparkSession, state: str) -> DataFrame:
    """All stored versions: feed, structure, changes, number."""
    return read_or_empty(spark, state, VERSIONS)


def current(spark: SparkSession, state: str) -> Structure | None:
    """The newest version; None if nothing was registered."""
    row = versions(spark, state).agg(F.max_by(F.struct("structure", "changes", "version"), "version").alias("v")).first()["v"]
    if row is None:
        return None
    return Structure(row["version"], T.StructType.fromJson(json.loads(row["structure"])), [tuple(c) for c in row["changes"]])


def register(spark: SparkSession, state: str, feed: str, found: T.StructType) -> Structure:
    """Merge a delivery's structure into the stored one. A version is written only if the merged
    structure is another one; ``changes`` of the result tells of absent fields in any case."""
    stored = current(spark, state)
    listed = changes(stored.schema if stored else T.StructType(), found)
    merged = union(stored.schema, found) if stored else union(found, T.StructType())
    if stored and merged == stored.schema:
        return Structure(stored.version, merged, listed)
    version = stored.version + 1 if stored else 1
    row = spark.createDataFrame([(feed, merged.json(), listed)], VERSIONS.rsplit(",", 1)[0])
    try:
        row.coalesce(1).write.mode("errorifexists").parquet(f"{state}/version={version}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_ALREADY_EXISTS":
            raise
        raise RuntimeError(f"version {version} was written by another run") from error
    return Structure(version, merged, listed)


def read_registered(spark: SparkSession, paths: Sequence[str] | str, state: str, **options) -> DataFrame:
    """Deliveries of all registered feeds in one scan by the newest structure. Fields that a
    document lacks are null; a single element is an array of one where any feed has several."""
    known = current(spark, state)
    if known is None:
        raise ValueError(f"no structure was registered in {state}")
    return xml.read_meter_xml(spark, paths, schema=known.schema.add(spec.CORRUPT_COLUMN, "string"), **options)
