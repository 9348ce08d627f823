"""Meter documents from XML files or XML text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterloom import spec

#: Field for the text of an element that has attributes or children too.
VALUE_TAG = "_text_content"


def _options(mode: str, timezone: str | None) -> dict[str, str]:
    options = {
        "rowTag": spec.ROW_TAG,
        "attributePrefix": "_",
        "valueTag": VALUE_TAG,
        "nullValue": "",
        "ignoreNamespace": "true",
        "mode": mode,
    }
    if mode.upper() == "PERMISSIVE":
        options["columnNameOfCorruptRecord"] = spec.CORRUPT_COLUMN
    if timezone:
        options["timezone"] = timezone
    return options


def document_schema(mode: str = "PERMISSIVE", layout: str = spec.METER_DOCUMENT) -> str:
    corrupt = f", {spec.CORRUPT_COLUMN} STRING" if mode.upper() == "PERMISSIVE" else ""
    return layout + corrupt


def read_meter_xml(
    spark: SparkSession,
    paths: Sequence[str] | str,
    row_tag: str = spec.ROW_TAG,
    mode: str = "PERMISSIVE",
    schema: str | T.StructType | None = None,
    infer: bool = False,
    share: float | None = None,
    part_date: str | None = None,
    timezone: str | None = None,
    recursive: bool = False,
    spread: int | None = None,
) -> DataFrame:
    """One row per meter document, with the file it came from.

    ``paths`` is a list of files, folders or globs, all read by one scan; gzip is recognised by
    suffix. A gzip file cannot be split, so it is one task: ``spread`` redistributes the parsed
    documents over that many partitions. ``infer=True`` lets Spark derive the structure from
    the files, or from a ``share`` of the documents; leaves stay text, so that a meter name keeps
    its leading zeros.
    """
    reader = spark.read.format("xml").options(**_options(mode, timezone)).option("rowTag", row_tag)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if infer:
        reader = reader.option("inferSchema", "false")
        if share is not None:
            reader = reader.option("samplingRatio", str(share))
    else:
        reader = reader.schema(schema or document_schema(mode))
    listed = [paths] if isinstance(paths, str) else list(paths)
    df = reader.load(listed).withColumn("filename", F.col("_metadata.file_path"))
    if part_date is not None:
        df = df.withColumn("part_date", F.lit(part_date))
    return df if spread is None else df.repartition(spread)


def parse_meter_xml(
    df: DataFrame, column: str, mode: str = "PERMISSIVE", layout: str = spec.METER_DOCUMENT
) -> DataFrame:
    """Meter documents parsed from a text column; other columns are carried along. Every text is
    read whole, and a fault anywhere in it is found, whatever part of a document's ``layout`` is
    asked for (see ``flatten.layout``)."""
    parsed = F.from_xml(F.col(column), document_schema(mode, layout), _options(mode, None))
    carried = [c for c in df.columns if c != column]
    # Unpacked through a generator: as a projection the optimizer would copy the parser into
    # every later expression that uses one of its fields.
    return df.select(*carried, F.inline(F.array(parsed)))


def corrupt_rows(documents: DataFrame) -> DataFrame:
    """Documents, how many of them could not be parsed, and how many have no meter name.

    A scan of files answers for the corrupt column only next to another one, which the name is.
    """
    return documents.agg(
        F.count(F.lit(1)).alias("documents"),
        F.count(spec.CORRUPT_COLUMN).alias("corrupt"),
        F.count_if(F.col("_MeterName").isNull()).alias("unnamed"),
    )


#: Documents in one written file. A file is read by one task, whether it is compressed or not, so
#: this and not the size of the feed bounds a task, and small files are even work for all cores.
FILE_DOCUMENTS = 1_000_000


def write_meter_xml(
    documents: DataFrame,
    path: str,
    compression: str | None = "gzip",
    file_documents: int = FILE_DOCUMENTS,
) -> None:
    """Documents as XML files of at most ``file_documents`` each, compressed unless ``compression``
    is None."""
    writer = (
        documents.write.format("xml")
        .option("rowTag", spec.ROW_TAG)
        .option("rootTag", "MeterFeed")
        .option("attributePrefix", "_")
        .option("maxRecordsPerFile", str(file_documents))
        .mode("errorifexists")
    )
    (writer.option("compression", compression) if compression else writer).save(path)
