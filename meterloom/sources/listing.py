"""Which files are ready to be read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom import spec
from meterloom.operators.joins import lookup_join


def list_files(spark: SparkSession, base: str) -> DataFrame:
    """Path, modification time and size of every file below ``base``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(base)
        .select("path", "modificationTime", "length")
    )


def with_layout(listing: DataFrame, base: str) -> DataFrame:
    """Adds the first-level folder below ``base``, the depth and the file name."""
    marker = f"{base.strip('/')}/"
    # The base is cut off where it stands first; a folder below may repeat its name.
    relative = F.substr(F.col("path"), F.locate(marker, F.col("path")) + F.lit(len(marker)))
    return listing.withColumns(
        {
            "directory": F.substring_index(relative, "/", 1),
            "depth": F.length(relative) - F.length(F.replace(relative, F.lit("/"))) + 1,
            "file_name": F.substring_index(relative, "/", -1),
        }
    )


def ready_files(
    listing: DataFrame,
    start,
    end,
    marker: str = spec.MARKER_FILE,
    max_depth: int = 2,
    min_size: int = 0,
    contains: str = ".xml",
    **bounds,
) -> DataFrame:
    """Data files of the folders whose marker file changed in ``[start, end)``.

    ``listing`` has ``path``, ``modificationTime``, ``length`` and the columns of
    ``with_layout``. A data file is larger than ``min_size`` and has ``contains`` in its name.
    """
    changed = F.col("modificationTime")
    kind = listing.schema["modificationTime"].dataType
    is_marker = (
        (F.col("file_name") == marker)
        & (F.col("depth") > 1)
        & (F.col("depth") <= max_depth)
        & (changed >= F.lit(start).cast(kind))
        & (changed < F.lit(end).cast(kind))
    )
    ready = listing.filter(is_marker).select(F.col("directory").alias("ready_directory")).distinct()
    data = listing.filter(
        (F.col("length") > min_size) & F.contains("file_name", F.lit(contains)) & ~is_marker
    )
    return lookup_join(data, ready, {"directory": "ready_directory"}, ["path"], how="left_semi", **bounds).select(
        *listing.columns
    )


def ready_files_summary(files: DataFrame) -> DataFrame:
    return files.groupBy("directory").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )
