"""Windows over arriving files: each file is read once, and progress moves on only after success.

The state of an intake is a folder. ``windows/version=N`` holds one row for each finished window:
from when to when it went. ``files/version=N`` lists the files that the window read, written before
they are read. A window starts where the newest finished one ended. What a finished window has
read is not selected again, also if its folder is marked as ready a second time; a file that
was written anew counts as another file. Finishing a window is a compare and set: it writes the next
version, and fails if someone else has written it since the window was opened.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.operators.joins import lookup_join
from meterloom.sinks.tables import read_or_empty
from meterloom.sources.listing import ready_files

FILES = "path string, modificationTime timestamp_ntz, length long, version long"
WINDOWS = "window_start timestamp_ntz, last_processed timestamp_ntz, files long, bytes long, version long"
#: Paths that one scan is given; a window with more of them is refused rather than cut.
MOST_FILES = 500_000


@dataclass(frozen=True)
class Window:
    """A window that was opened: the version it will write, its bounds and the files to read."""

    version: int
    start: dt.datetime | None
    end: dt.datetime
    paths: list[str]


def windows(spark: SparkSession, state: str) -> DataFrame:
    """The finished windows; the newest ``last_processed`` is the control value."""
    return read_or_empty(spark, f"{state}/windows", WINDOWS)


def files_read(spark: SparkSession, state: str) -> DataFrame:
    """Files of finished windows: those of a window that failed are listed, but not read."""
    done = windows(spark, state).select(F.col("version").alias("done"))
    listed = read_or_empty(spark, f"{state}/files", FILES)
    return listed.join(F.broadcast(done), F.col("version") == F.col("done"), "left_semi")


def open_window(
    spark: SparkSession,
    listing: DataFrame,
    state: str,
    end: dt.datetime,
    first: dt.datetime = dt.datetime(1970, 1, 1),
    most: int = MOST_FILES,
    **ready,
) -> Window:
    """The files to read up to ``end``: those of folders marked ready since the last window (since
    ``first``, if there was none) that no finished window has read.

    ``listing`` and ``ready`` are those of ``ready_files``. The selected files are entered in the
    state; nothing else changes, so a window may be opened again until one is finished.
    """
    newest = windows(spark, state).agg(F.max("version").alias("v"), F.max("last_processed").alias("t")).first()
    version, start = (newest["v"] or 0) + 1, newest["t"] or first
    if end < start:
        raise ValueError(f"the window would end at {end}, before the last one did, at {start}")
    when = F.col("modificationTime").cast("timestamp_ntz")
    chosen = ready_files(listing, start, end, **ready).select("path", when.alias("modificationTime"), "length").distinct()
    known = files_read(spark, state).select(F.col("path").alias("p"), F.col("modificationTime").alias("m")).distinct()
    fresh = lookup_join(chosen, known, {"path": "p", "modificationTime": "m"}, ["length"], how="left_anti")
    at = f"{state}/files/version={version}"
    fresh.write.mode("overwrite").parquet(at)
    written = read_or_empty(spark, at, FILES).select("path")
    if written.count() > most:
        raise ValueError(f"more than {most} files in one window; close it earlier")
    return Window(version, start, end, sorted(r["path"] for r in written.collect()))


def finish_window(spark: SparkSession, state: str, window: Window) -> None:
    """Move the control value to the window's end. Fails if another window was finished since."""
    newest = windows(spark, state).agg(F.max("version")).first()[0] or 0
    if newest != window.version - 1:
        raise RuntimeError(f"window {window.version} was opened after {window.version - 1}, but {newest} is finished")
    read = read_or_empty(spark, f"{state}/files/version={window.version}", FILES)
    row = read.agg(F.count("path").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).select(
        F.lit(window.start).cast("timestamp_ntz").alias("window_start"),
        F.lit(window.end).cast("timestamp_ntz").alias("last_processed"),
        "files",
        "bytes",
    )
    try:
        row.coalesce(1).write.mode("errorifexists").parquet(f"{state}/windows/version={window.version}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_ALREADY_EXISTS":
            raise
        raise RuntimeError(f"window {window.version} was finished by another run") from error


def run_window(
    spark: SparkSession,
    listing: DataFrame,
    state: str,
    end: dt.datetime,
    read: Callable[[list[str]], DataFrame],
    process: Callable[[DataFrame, Window], None],
    **options,
) -> Window:
    """Open a window, read its files in one scan, process them, finish the window. If processing
    fails the control value stays, and the next run selects the same files again. A window
    without files is finished too."""
    window = open_window(spark, listing, state, end, **options)
    if window.paths:
        process(read(window.paths), window)
    finish_window(spark, state, window)
    return window
