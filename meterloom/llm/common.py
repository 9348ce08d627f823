"""What several operators share: written intermediate tables, bounded broadcasts, word splitting."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.session import scratch_path

#: Rows up to which a table of a few numbers a row is sent to every executor (about 32 MB).
BROADCAST_ROWS = 1_000_000
#: Bytes of one Arrow batch between Spark and a Python worker. Either side holds a few copies of it.
BATCH_BYTES = 6 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Let no Arrow batch of this session exceed ``BATCH_BYTES`` (but for a longer single row), so
    that what a task holds outside the heap does not follow the length of texts. A session's own
    setting stays. It holds for the session, since lazy results are computed later."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == "67108864b":  # Spark's own value
        spark.conf.set(name, str(BATCH_BYTES))


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts the lineage, and what
    follows sees the same rows however often tasks are run again."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_bucketed(df: DataFrame, label: str, key: str, buckets: int | None = None, names: list[str] | None = None) -> DataFrame:
    """As ``stage``, as a table bucketed by ``key``: later joins and windows on the key start
    without a shuffle of it. The table's name is added to ``names`` (see ``drop_tables``)."""
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        df.write.format("parquet")
        .option("path", scratch_path(spark, label))
        .bucketBy(count, key)
        .sortBy(key)
        .saveAsTable(name)
    )
    if names is not None:
        names.append(name)
    return spark.table(name)


def drop_tables(spark: SparkSession, names: Sequence[str]) -> None:
    """Take written tables out of the catalog, once nothing reads them any more; files stay in the scratch folder."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows; else Spark shuffles it."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def documents_like(result: DataFrame, docs: DataFrame) -> DataFrame:
    return result.select(*[F.col(f"`{c}`") for c in docs.columns])
