"""Files of a stated size in a partitioned folder.

Sizes come from the folder's listing; contents are read only where something is to be done. In each
partition, small files are put together, in the order of their sizes, up to the stated size, and
a file that is much larger is divided. Every such group is one task and one file. Partitions whose
files all fit already are left alone, and the others are replaced whole, through a staged copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from meterloom.operators.joins import lookup_join
from meterloom.session import stage_once

#: A file is too small below, too large above these shares of the stated size.
SMALL, LARGE = 0.5, 1.5


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Data files below ``path``: partition folder, path and bytes, and ``file``, the path as a scan
    of the rows names it (which escapes what the listing does not)."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    return listed.select(
        F.element_at(F.split("path", "/"), -2).alias("folder"), F.col("_metadata.file_path").alias("file"), "length"
    )


def file_groups(files: DataFrame, target_bytes: int) -> DataFrame:
    """The files of partitions that have something to do: ``folder``, ``file``, ``group`` (a number
    within the folder) and ``parts`` (into how many a file is divided, mostly 1)."""
    size = F.col("length")
    small, large = size < SMALL * target_bytes, size > LARGE * target_bytes
    of_folder = Window.partitionBy("folder")
    judged = files.withColumns(
        {"small": F.count_if(small).over(of_folder), "large": F.count_if(large).over(of_folder)}
    ).filter("small > 1 OR large > 0")
    # Files that fit keep a group of their own; small ones fill one group after the other.
    fitting = F.when(large, F.ceil(size / target_bytes)).otherwise(1).cast("int")
    kept = judged.withColumns({"parts": fitting, "alone": ~small})
    before = Window.partitionBy("folder", "alone").orderBy("length", "file").rowsBetween(Window.unboundedPreceding, -1)
    filled = F.floor(F.coalesce(F.sum("length").over(before), F.lit(0)) / target_bytes)
    single = F.row_number().over(Window.partitionBy("folder", "alone").orderBy("length", "file"))
    return kept.select(
        "folder", "file", F.when(F.col("alone"), -single).otherwise(filled).cast("long").alias("group"), "parts"
    )


def compact(spark: SparkSession, path: str, partition: str, target_bytes: int) -> int:
    """Rewrite the partitions of a Parquet folder that have several small files or a large one, so
    that files have about ``target_bytes``. Rows stay as they are. Returns the files written.

    A group of small files holds less than ``target_bytes`` and one small file; a divided file's
    parts are as large as each other by rows. One writer at a time, as for a merge.
    """
    plan = stage_once(file_groups(file_sizes(spark, path), target_bytes), "compaction-plan")
    if plan.isEmpty():
        return 0
    # Numbers for the files to be: within a folder first, then over the folders.
    of_folder = Window.partitionBy("folder").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = plan.groupBy("folder", "group").agg(F.max("parts").alias("parts"))
    groups = groups.withColumn("first", F.coalesce(F.sum("parts").over(of_folder), F.lit(0)))
    folders = groups.groupBy("folder").agg(F.sum("parts").alias("n")).orderBy("folder").collect()
    total, starts = 0, []
    for row in folders:
        starts.append((row["folder"], total))
        total += row["n"]
    starts = spark.createDataFrame(starts, "folder string, start long")
    places = plan.drop("parts").join(groups, ["folder", "group"]).join(F.broadcast(starts), "folder")
    places = stage_once(
        places.select("file", (F.col("first") + F.col("start")).alias("first"), "parts"),
        "compaction-places",
    )

    listed = [f"{path.rstrip('/')}/{row['folder']}" for row in folders]
    found = spark.read.option("basePath", path).parquet(*listed).schema
    # A partition's value is a text here: as a number, 007 would go to another folder.
    layout = StructType([StructField(f.name, StringType()) if f.name == partition else f for f in found])
    rows = spark.read.schema(layout).option("basePath", path).parquet(*listed)
    marked = rows.withColumn("_file", F.col("_metadata.file_path"))
    placed = lookup_join(marked, places, {"_file": "file"}, [c for c in rows.columns if c != partition][:1], how="inner")
    part = F.col("first") + F.pmod(F.monotonically_increasing_id(), F.col("parts"))
    staged = stage_once(placed.select(*rows.columns, part.cast("int").alias("_part")), "compaction-rows")
    if staged.count() != rows.count():  # both from the files' own counts
        raise ValueError(f"files of {path} changed while they were read; nothing was replaced")
    (
        staged.repartitionById(total, F.col("_part"))
        .drop("_part")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
    return total
