"""Target table, change feed, held rows and the written merge."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterloom import spec
from meterloom.operators import merge as m
from meterloom.operators.audit import touched_dates_frame, touched_dates_range
from meterloom.operators.dedup import keep_latest
from meterloom.session import freed_shuffles, scratch_path
from meterloom.sinks.slices import SLICE_ROWS, slices


def create_target(
    spark: SparkSession,
    name: str,
    location: str,
    columns: Sequence[str] = tuple(spec.TARGET_COLUMNS),
    partition: Sequence[str] = (spec.TARGET_PARTITION,),
    recreate: bool = False,
) -> None:
    """Create the partitioned target. An existing one is dropped only on request."""
    if recreate:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({spec.ddl(list(columns))}) USING parquet "
        f"PARTITIONED BY ({', '.join(partition)}) LOCATION '{location}'"
    )


def describe_target(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {name}")


def insert_target(df: DataFrame, name: str) -> None:
    """Append rows to the target, matched by name (a table lists its partition columns last)."""
    spark = df.sparkSession
    columns = spark.table(name).columns
    with freed_shuffles(spark):
        df.select(*columns).hint("rebalance", spec.TARGET_PARTITION).write.insertInto(name)


def overwrite_staging(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once and read it back, so that what follows starts from files."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_partitioned(df: DataFrame, path: str, partition: Sequence[str]) -> None:
    """Append, with rows gathered by partition value first: few files per partition, and a
    partition that holds most of the rows is split over several tasks."""
    df.hint("rebalance", *partition).write.mode("append").partitionBy(*partition).parquet(path)


def append_feed(feed: DataFrame, path: str) -> None:
    """Append one run's feed. Unit and run label are the same in all its rows, so every task
    writes to one folder as it is and nothing needs to be gathered first."""
    feed.write.mode("append").partitionBy("aep_opco", "run_date").parquet(path)


def append_held(held_rows: DataFrame, path: str) -> None:
    """Append one run's held rows, which share their run day."""
    held_rows.write.mode("append").partitionBy("run_dt").parquet(path)


def save_held_table(held_rows: DataFrame, table: str) -> None:
    held_rows.write.mode("append").partitionBy("run_dt").format("parquet").saveAsTable(table)


def drop_listed(spark: SparkSession, table: str, partitions: Sequence[dict[str, str]]) -> None:
    """Drop the listed partitions (column to value) of a table, all in one statement."""

    def quoted(value: str) -> str:
        return value.replace("\\", "\\\\").replace("'", "\\'")

    parts = [", ".join(f"`{column}`='{quoted(value)}'" for column, value in p.items()) for p in partitions]
    if parts:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(f'PARTITION ({p})' for p in parts)}")


def drop_partitions(spark: SparkSession, table: str) -> int:
    """Drop every partition that a table has now; to drop what was released, see ``release``. The
    catalog lists them as folder names, so their values are decoded first."""
    found = [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    drop_listed(spark, table, [dict(map(unquote, level.split("=", 1)) for level in entry.split("/")) for entry in found])
    return len(found)


def write_merge(
    spark: SparkSession,
    source: DataFrame,
    target: str,
    keys: Sequence[str] = tuple(spec.MERGE_KEYS),
    update_cols: Sequence[str] = tuple(spec.MERGE_UPDATE_COLUMNS),
    partition: str = spec.TARGET_PARTITION,
    labels: tuple[str, str] = spec.MERGE_LABELS,
    label_col: str | None = spec.LABEL_COLUMN,
    order: Sequence[str] | None = None,
    matched: bool = True,
    not_matched: bool = True,
    staging: str | None = None,
    slice_rows: int = SLICE_ROWS,
) -> dict[str, int]:
    """Merge ``source`` into a Parquet table partitioned by ``partition``; returns the counts.

    ``target`` is a table of the catalog, by name, or a path (a name holds no slash). A named
    table is written through the catalog, so partitions that are new are registered with it.

    1. The source is written to staging once, so the later steps all see the same rows.
       With ``order`` only the latest row per key is kept; without it a key that occurs twice
       is refused.
    2. Only target partitions that the source touches are read: the first and the last value
       bound the scan of the target, a semi join with the distinct values does the rest.
       The target keeps its layout: its columns and types stay, columns that only it has keep
       their values (null in inserted rows), and a source column it lacks is refused.
    3. The merged rows are written to staging, where ``partition`` is one of the keys in slices of
       some ``slice_rows`` rows by its value, as rows can match within it only. Nothing in the
       target has changed so far, and a failure up to here leaves it as it was.
    4. Staged rows replace exactly the touched partitions (dynamic partition overwrite).

    Replacement is atomic per partition, not across partitions, so a reader may see some of
    them replaced before others; one writer at a time. If step 4 is interrupted, running the
    merge again with the same source completes it: apart from labels, merging the same rows
    twice gives the same target. Rows with a null in their key are the exception, as they are
    in SQL: they equal nothing and are inserted by every run.

    The staging folder is new for each call and is left for the scratch folder's own clean-up.
    """
    base = staging or scratch_path(spark, "merge")
    if order is not None:
        source = keep_latest(source, list(keys), list(order))
    with freed_shuffles(spark):
        staged = overwrite_staging(source, f"{base}/source")
    if order is None:
        for part in slices(staged, F.col(partition), slice_rows) if partition in keys else [F.lit(True)]:
            with freed_shuffles(spark):
                if not m.duplicate_keys(staged.filter(part), keys).isEmpty():
                    raise ValueError("the source holds more than one row for a merge key")

    before = read_target(spark, target, source, partition)
    unknown = [c for c in source.columns if c not in before.columns]
    if unknown:
        raise ValueError(f"the target has no column {', '.join(unknown)}")
    touched_range = touched_dates_range(staged, partition).first()
    dated = staged.filter(F.col(partition).isNotNull())
    counts = {"update": 0, "insert": 0, "keep": 0}

    if touched_range["dates"]:
        within = F.col(partition).between(touched_range["first_date"], touched_range["last_date"])
        touched = before.filter(within).join(touched_dates_frame(staged, partition), partition, "left_semi")
        touched = touched.select(*before.columns)
        parts = [F.lit(True)]
        if partition in keys and before.schema[partition].dataType == staged.schema[partition].dataType:
            parts = slices(dated.select(partition).unionByName(touched.select(partition)), F.col(partition), slice_rows)
        for k, part in enumerate(parts):
            with freed_shuffles(spark):
                merged = m.merge_upsert(
                    touched.filter(part), dated.filter(part), keys, update_cols, labels, label_col,
                    matched, not_matched, keep_op=True,
                )
                # Rebalancing splits a day that holds most of the rows and joins small ones.
                merged.hint("rebalance", partition).write.mode("append" if k else "overwrite").parquet(f"{base}/merged")
        result = spark.read.schema(merged.schema).parquet(f"{base}/merged")
        counts |= {r[0]: r[1] for r in result.groupBy(m.OP).count().collect()}
        replace_partitions(result.drop(m.OP), target, partition)

    if not_matched:
        # A row without a day matches nothing and touches no listed partition: it is added.
        undated = staged.filter(F.col(partition).isNull())
        n = undated.count()
        if n:
            if label_col in undated.columns:
                undated = undated.withColumn(label_col, F.lit(labels[1]))
            undated = m.in_layout(undated, before)
            if _is_table(target):
                undated.select(*before.columns).write.insertInto(target)
            else:
                undated.write.mode("append").partitionBy(partition).parquet(target)
            counts["insert"] += n
    return counts


def _is_table(target: str) -> bool:
    return "/" not in target


def read_target(spark: SparkSession, path: str, like: DataFrame, partition: str) -> DataFrame:
    """The target in its own layout; a target that was never written is empty, in the source's. A table of the catalog has both.

    A partition column gets its type from the folder names, so the source's type is kept for it.
    """
    if _is_table(path):
        return spark.table(path)
    try:
        found = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], like.schema)
    given = {f.name: f for f in like.schema}
    layout = StructType([given[f.name] if f.name == partition and f.name in given else f for f in found.schema])
    return spark.read.schema(layout).parquet(path)


def read_or_empty(spark: SparkSession, path: str, layout: str | StructType) -> DataFrame:
    """The rows of a folder that only grows; none if it was never written."""
    try:
        return spark.read.schema(layout).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], layout)


def replace_partitions(df: DataFrame, path: str, partition: str) -> None:
    if _is_table(path):
        spark, mode = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
        was = spark.conf.get(mode)
        spark.conf.set(mode, "dynamic")
        try:
            df.select(*spark.table(path).columns).write.insertInto(path, overwrite=True)
        finally:
            spark.conf.set(mode, was)
        return
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
