"""Documents that cannot be used are kept apart, and read again once they can.

A batch of document texts is parsed once. Documents that parse and name their meter go on; the
others are entered in a quarantine with their text, where they came from, the cause and the
number of the attempt. A replay takes the entries that are still open, lets the caller mend the
texts, and parses them as the next attempt: what parses goes on and is closed, the rest is entered
again. Entries are only ever added, in a folder for each batch and attempt, which a second run
of the same attempt replaces, so nothing goes on twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom import spec
from meterloom.session import stage_once
from meterloom.sinks.tables import read_or_empty
from meterloom.sources.xml import parse_meter_xml

ENTRIES = "record long, origin string, text string, cause string, closed boolean, batch string, attempt int"
MALFORMED, UNNAMED = "malformed", "unnamed"
_TEXT, _RECORD, _ORIGIN = "_text", "_record", "_origin"


def entries(spark: SparkSession, path: str, batch: str | None = None) -> DataFrame:
    """All that the quarantine holds, of one batch or all."""
    found = read_or_empty(spark, path, ENTRIES)
    return found if batch is None else found.filter(F.col("batch") == batch)


def open_entries(spark: SparkSession, path: str, batch: str) -> DataFrame:
    """The newest entry of each document of a batch that has not parsed yet."""
    of_batch = entries(spark, path, batch)
    newest = of_batch.agg(F.max("attempt")).first()[0]
    return of_batch.filter(F.lit(False) if newest is None else (F.col("attempt") == newest) & ~F.col("closed"))


def take(
    texts: DataFrame, column: str, origin: Column, path: str, batch: str, layout: str = spec.METER_DOCUMENT
) -> DataFrame:
    """The usable documents among ``texts``, with ``_record`` (a number for each) and ``_origin``;
    the others are entered in the quarantine at ``path`` as the batch's first attempt.

    ``column`` holds the text, ``origin`` says where it came from. A null text is malformed.
    Repeated texts are documents of their own. Other columns are carried along. ``layout`` is that of
    ``parse_meter_xml``, with the meter's name in it. Run again, the batch is taken anew: a batch
    with later attempts is refused.
    """
    spark = texts.sparkSession
    later = entries(spark, path, batch).filter("attempt > 1")
    if not later.isEmpty():
        raise ValueError(f"batch {batch} has been replayed already")
    numbered = texts.select(
        *[c for c in texts.columns if c != column],
        F.col(column).alias(_TEXT),
        origin.cast("string").alias(_ORIGIN),
        F.monotonically_increasing_id().alias(_RECORD),
    )
    return _attempt(numbered, path, batch, 1, layout)


def replay(
    spark: SparkSession,
    path: str,
    batch: str,
    mend: Callable[[Column], Column] | None = None,
    layout: str = spec.METER_DOCUMENT,
) -> DataFrame:
    """The documents of a batch that are usable now, of those still open. ``mend`` turns a text into
    the one to parse; the entry of a document that stays unusable keeps its text as it was."""
    still = open_entries(spark, path, batch)
    attempt = (still.agg(F.max("attempt")).first()[0] or 0) + 1
    if attempt == 1:
        return _attempt(still.select(F.col("text").alias(_TEXT), F.col("origin").alias(_ORIGIN), F.col("record").alias(_RECORD)), path, batch, None, layout)
    text = F.col("text") if mend is None else mend(F.col("text"))
    again = still.select(text.alias(_TEXT), F.col("origin").alias(_ORIGIN), F.col("record").alias(_RECORD), F.col("text").alias("_was"))
    return _attempt(again, path, batch, attempt, layout)


def _attempt(numbered: DataFrame, path: str, batch: str, attempt: int | None, layout: str) -> DataFrame:
    """Parse once, enter what an attempt has to enter (none: nothing), return what is usable. Texts
    are written with the rows that are entered only."""
    kept = numbered.withColumn("_was", F.col("_was") if "_was" in numbered.columns else F.col(_TEXT))
    parsed = parse_meter_xml(kept.withColumn("_parse", F.col(_TEXT)), "_parse", layout=layout)
    broken = F.col(_TEXT).isNull() | F.col(spec.CORRUPT_COLUMN).isNotNull()
    cause = F.when(broken, MALFORMED).when(F.trim("_MeterName").isNull() | (F.trim("_MeterName") == ""), UNNAMED)
    # From the second attempt on, documents that parse now are entered too, as closed.
    entering = F.col("_cause").isNotNull() | F.lit(attempt is not None and attempt > 1)
    named = parsed.withColumn("_cause", cause).withColumn("_was", F.when(entering, F.col("_was")))
    judged = stage_once(named.drop(_TEXT, spec.CORRUPT_COLUMN), "quarantine-parsed")
    if attempt is not None:
        entered = judged.filter(entering).select(
            F.col(_RECORD).alias("record"), F.col(_ORIGIN).alias("origin"), F.col("_was").alias("text"),
            F.col("_cause").alias("cause"), F.col("_cause").isNull().alias("closed"),
        )
        entered.write.mode("overwrite").parquet(f"{path}/batch={batch}/attempt={attempt}")
    return judged.filter(F.col("_cause").isNull()).drop("_cause", "_was")
