"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "meterloom") -> SparkSession:
    """A session for tests and the bench; on a cluster the submitter configures it."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the folder every executor can reach.

    The folder is the one named by ``spark.checkpoint.dir``. Only a local session may go
    without that setting; it then gets a temporary folder, for it runs on one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="meterloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/meterloom/{label}-{uuid.uuid4().hex}"


def cut_lineage(df):
    """Reliable checkpoint of ``df`` in the shared folder (survives the loss of executors)."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_path(spark, "checkpoint"))
    return df.checkpoint(eager=True)


def stage_once(df, label: str):
    """``df`` written to the shared folder and read back: computed once, whatever reads it."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries made and run inside go when each one ends, instead of when the
    driver's garbage collector finds them. A query that runs again writes its own anew."""
    was = spark.conf.get(_FREE)
    spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE, was)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
