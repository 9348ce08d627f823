"""Incremental intake, streaming deduplication and streaming upsert.

Every run processes what has arrived since the last one and stops (``availableNow``); the
checkpoint remembers what was read, so nothing is taken twice and nothing is skipped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from meterloom import spec
from meterloom.sinks.ledger import merge_once
from meterloom.sinks.tables import write_merge
from meterloom.sources.xml import _options, document_schema


def stream_parquet(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def stream_meter_xml(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.format("xml").options(**_options("PERMISSIVE", None)).schema(document_schema())
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def run_once(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append all that is new to Parquet files, then stop."""
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return query


def keep_first(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """The first row seen of each key; keys are forgotten once the watermark has passed them."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


#: Groups that the keys of ``keep_first_for`` are dealt to. Python is called once for each of them
#: and batch, not once for each key.
KEY_GROUPS = 256


def _key_text(field: T.StructField) -> Column:
    """A text that two values have in common if and only if they are one key."""
    kind, c = field.dataType, F.col(field.name)
    if isinstance(kind, T.TimestampType):
        c = F.unix_micros(c)
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        c = c + F.lit(0).cast(kind)  # minus zero is zero
    elif isinstance(kind, T.BinaryType):
        c = F.hex(c)
    elif isinstance(kind, (T.StructType, T.ArrayType, T.VariantType)):
        c = F.to_json(F.struct(c))
    text = c.cast("string")
    return F.coalesce(F.concat(F.length(text), F.lit(":"), text), F.lit("-"))


def keep_first_for(
    stream: DataFrame,
    keys: Sequence[str],
    event_time: str,
    forget: str,
    lateness: str = "0 seconds",
    groups: int = KEY_GROUPS,
) -> DataFrame:
    """The first row of each key, whole, and the first again once ``forget`` has passed since the
    row that was kept: a row is kept if no row of its key was kept in the time ``forget`` before it.

    Keys are dealt to ``groups`` groups, and the state of a group is the time of each of its keys'
    kept rows. A timer drops a key when the watermark (the latest time seen less ``lateness``) has
    passed that time by ``forget``, so state holds the keys of that span only. Within a batch rows
    are taken by time, then by their other columns; rows that arrive behind the watermark are
    dropped and counted (``late_rows``). A group's rows of one batch are sorted in one task's
    memory, which the size of a batch and the number of groups bound; that number stays as it is
    for the life of a checkpoint. Rows without a time have no place in the order and are dropped;
    null keys are a key.
    """
    columns = stream.columns
    span = pd.Timedelta(forget).value // 1000
    # Whole numbers travel without nulls, which pandas could hold only as floats.
    whole = [f.name for f in stream.schema if isinstance(f.dataType, T.IntegralType)]
    sent = [x for c in columns for x in ((f"_there_{c}", c) if c in whole else (c,))]
    order = ["_at", *[c for c in sent if c != event_time]]

    def step(key: tuple, batches, state):
        known = dict(zip(*state.get, strict=True)) if state.exists else {}
        chosen = None
        if not state.hasTimedOut:
            rows = pd.concat(list(batches)).sort_values(order, kind="stable", na_position="first")
            places = []
            for place, (name, at) in enumerate(zip(rows["_key"].tolist(), rows["_at"].tolist(), strict=True)):
                kept = known.get(name)
                if kept is None or at > kept + span:
                    places.append(place)
                    known[name] = at
            chosen = rows.iloc[places][sent]
        watermark = state.getCurrentWatermarkMs()
        left = {name: at for name, at in known.items() if (at + span) // 1000 + 1 > watermark}
        if left:
            state.update((list(left), list(left.values())))
            state.setTimeoutTimestamp((min(left.values()) + span) // 1000 + 1)
        elif state.exists:
            state.remove()
        if chosen is not None and len(chosen):
            yield chosen

    fields = {f.name: f for f in stream.schema}
    timed = stream.filter(F.col(event_time).isNotNull()).withWatermark(event_time, lateness)
    dealt = timed.select(
        *[F.coalesce(c, F.lit(0).cast(fields[c].dataType)).alias(c) if c in whole else F.col(c) for c in columns],
        *[F.col(c).isNotNull().alias(f"_there_{c}") for c in whole],
        F.unix_micros(event_time).alias("_at"),
        F.concat(*[_key_text(fields[k]) for k in keys]).alias("_key"),
    ).withColumn("_group", F.pmod(F.xxhash64("_key"), F.lit(groups)))
    schema = ", ".join(f"`{c}` {fields[c].dataType.simpleString() if c in fields else 'boolean'}" for c in sent)
    kept = dealt.groupBy("_group").applyInPandasWithState(
        step, schema, "keys array<string>, kept array<long>", "append", "EventTimeTimeout"
    )
    return kept.select(*[F.when(F.col(f"_there_{c}"), F.col(c)).alias(c) if c in whole else F.col(c) for c in columns])


def late_rows(query: StreamingQuery) -> int:
    """Rows that stateful operators of a run have dropped because they came behind the watermark."""
    return sum(int(o["numRowsDroppedByWatermark"]) for p in query.recentProgress for o in p["stateOperators"])


def upsert_stream(
    stream: DataFrame,
    target_path: str,
    checkpoint: str,
    keys: Sequence[str] = tuple(spec.MERGE_KEYS),
    order: Sequence[str] = ("hdp_insert_dttm",),
    on_batch: Callable[[int, dict[str, int]], None] | None = None,
    ledger: str | None = None,
    name: str | None = None,
    **merge_options,
) -> StreamingQuery:
    """Merge each micro-batch into the target.

    Spark runs a batch again, by the same number, if it does not know that it ended. With a
    ``ledger`` (a folder) such a batch changes nothing that it has changed before: every row
    arrives exactly once, under the stream's ``name`` (by default its checkpoint). Without one, a
    batch that is run again leaves the same target but for labels, and but for rows with a null
    in their key or without a day, which are inserted again.
    """

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if ledger is None:
            counts = write_merge(spark, batch, target_path, keys, order=order, **merge_options)
        else:
            counts = merge_once(
                spark, batch, target_path, name or checkpoint, batch_id, ledger, keys, order=order, **merge_options
            )
        if on_batch:
            on_batch(batch_id, counts)

    query = (
        stream.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
