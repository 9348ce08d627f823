"""A target kept in buckets of its merge key, so that a merge moves the source only.

The buckets are by the hash of the whole merge key, never of the meter alone: keys are unique in
the target, so its buckets are even also where one meter holds most readings. A scan of the target
then is partitioned as the join asks, and what is merged comes out in the same buckets, so neither
reading nor writing shuffles the target, however large it is. One shuffle of the source remains.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterloom import spec
from meterloom.operators import merge as m
from meterloom.operators.dedup import keep_latest
from meterloom.session import scratch_path
from meterloom.sinks.tables import overwrite_staging, replace_partitions

#: Touched partitions that are named one by one in the scan; beyond it the first and the last
#: one bound the scan, which rewrites those between them as they are.
NAMED = 10_000


#: Rows of a target that one bucket is meant for. A bucket is one task, so this bounds its memory.
BUCKET_ROWS = 1_000_000


def buckets_for(rows: int, least: int = 8, bucket_rows: int = BUCKET_ROWS) -> int:
    """The number of buckets for a target of so many rows."""
    return max(least, -(-rows // bucket_rows))


@dataclass(frozen=True)
class Layout:
    """How a table is bucketed and partitioned."""

    buckets: int
    keys: list[str]
    partition: str


def create_bucketed(
    spark: SparkSession,
    name: str,
    location: str,
    schema: StructType,
    partition: str = spec.TARGET_PARTITION,
    keys: Sequence[str] = tuple(spec.MERGE_KEYS),
    buckets: int = 64,
) -> None:
    """Create the target, partitioned by ``partition`` and in ``buckets`` buckets of the merge key
    in each partition. A bucket is read by one task over all touched partitions, so their number
    follows from the size of a usual merge's partitions, not from the table's. The partition
    column is no bucket column; the key may hold it."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    clustered = ", ".join(f"`{k}`" for k in keys if k != partition)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY (`{partition}`) "
        f"CLUSTERED BY ({clustered}) INTO {buckets} BUCKETS LOCATION '{location}'"
    )


def load_bucketed(df: DataFrame, name: str) -> None:
    """Append rows, dealt into the table's buckets first: one file per bucket and partition. Rows
    that lack all bucket columns would meet in one bucket, which the table's layout asks for."""
    buckets = layout(df.sparkSession, name)
    dealt = df.repartition(buckets.buckets, *buckets.keys)
    dealt.select(*df.sparkSession.table(name).columns).write.insertInto(name)


def layout(spark: SparkSession, name: str) -> Layout:
    """The layout of a table that ``create_bucketed`` made. The bucket's hash depends on the order
    of its columns, which is that of their definition and not that of the table."""
    partition = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    keys = re.findall(r"`((?:[^`]|``)+)`", told.get("Bucket Columns", ""))
    if len(partition) != 1 or not keys:
        raise ValueError(f"{name} is not a bucketed table with one partition column")
    return Layout(int(told["Num Buckets"]), [k.replace("``", "`") for k in keys], partition[0])


def touched_slice(target: DataFrame, staged: DataFrame, partition: str) -> DataFrame | None:
    """The rows of the target's partitions that ``staged`` touches, as a filter that the scan is
    pruned by; None if no row of it has a partition."""
    days = staged.filter(F.col(partition).isNotNull()).select(partition).distinct()
    named = [r[0] for r in days.limit(NAMED + 1).collect()]
    if not named:
        return None
    if len(named) <= NAMED:
        return target.filter(F.col(partition).isin(named))
    first, last = days.agg(F.min(partition), F.max(partition)).first()
    return target.filter(F.col(partition).between(first, last))


def merged_slice(
    target: DataFrame, source: DataFrame, buckets: Layout, keys: Sequence[str], update_cols: Sequence[str], **options
) -> DataFrame:
    """The slice after the merge, with ``_op``, in the target's buckets.

    The join is on the whole merge key, of which the buckets cover all but the partition column;
    the source is dealt into the same buckets, which is the one shuffle of the plan. Its rows with
    a null in their key are not dealt, since they could all meet in one bucket: they are inserted
    from where they are."""
    def deal(rows: DataFrame) -> DataFrame:
        return rows.repartition(buckets.buckets, *buckets.keys)

    return m.merge_upsert(target, source, keys, update_cols, keep_op=True, deal=deal, **options)


def merge_colocated(
    spark: SparkSession,
    source: DataFrame,
    name: str,
    keys: Sequence[str] = tuple(spec.MERGE_KEYS),
    update_cols: Sequence[str] = tuple(spec.MERGE_UPDATE_COLUMNS),
    labels: tuple[str, str] = spec.MERGE_LABELS,
    label_col: str | None = spec.LABEL_COLUMN,
    order: Sequence[str] | None = None,
    matched: bool = True,
    not_matched: bool = True,
) -> dict[str, int]:
    """Merge ``source`` into the bucketed table ``name``; the rows and the counts are those of
    ``write_merge``, and so are the rules for nulls, repeated keys and interruptions.

    The merged slice is written to a bucketed table of its own first, then it replaces the touched
    partitions bucket by bucket; both writes keep the join's partitioning. The staging table leaves
    the catalog at the end, also after a failure; its files stay for the scratch folder's clean-up.
    """
    target = spark.table(name)
    buckets = layout(spark, name)
    partition = buckets.partition
    if set(buckets.keys) != set(keys) - {partition}:
        raise ValueError(f"{name} is in buckets of {', '.join(buckets.keys)}, not of the merge key")
    unknown = [c for c in source.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"the target has no column {', '.join(unknown)}")
    if order is not None:
        source = keep_latest(source, list(keys), list(order))
    staged = overwrite_staging(source, scratch_path(spark, "merge"))
    if order is None and not m.duplicate_keys(staged, keys).isEmpty():
        raise ValueError("the source holds more than one row for a merge key")

    counts = {"update": 0, "insert": 0, "keep": 0}
    options = {"labels": labels, "label_col": label_col, "matched": matched, "not_matched": not_matched}
    touched = touched_slice(target, staged, partition)
    shared = "spark.sql.requireAllClusterKeysForCoPartition"
    scan = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    was = {k: spark.conf.get(k) for k in (shared, scan)}
    stage = f"meterloom_merge_{uuid4().hex}"
    try:
        # A key that holds the partition column is wider than the buckets, which still suffice.
        spark.conf.set(shared, "false")
        spark.conf.set(scan, "false")
        if touched is not None:
            dated = staged.filter(F.col(partition).isNotNull())
            create_bucketed(
                spark, stage, scratch_path(spark, "merged"), StructType([*target.schema]).add(m.OP, "string"),
                partition, buckets.keys, buckets.buckets,
            )
            merged = merged_slice(touched, dated, buckets, keys, update_cols, **options)
            merged.select(*spark.table(stage).columns).write.insertInto(stage)
            result = spark.table(stage)
            counts |= {r[0]: r[1] for r in result.groupBy(m.OP).count().collect()}
            replace_partitions(result.drop(m.OP), name, partition)
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
        spark.sql(f"DROP TABLE IF EXISTS {stage}")

    if not_matched:
        undated = staged.filter(F.col(partition).isNull())
        n = undated.count()
        if n:
            if label_col in undated.columns:
                undated = undated.withColumn(label_col, F.lit(labels[1]))
            m.in_layout(undated, target).write.insertInto(name)
            counts["insert"] += n
    return counts
