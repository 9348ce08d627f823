"""Merges that a replay leaves as they are.

A merge that is run again inserts rows with a null in their key a second time, since these match
nothing. So each batch of a stream is entered in a ledger: when its merged partitions have been
written beside the target (``staged``) and when they have replaced those of the target (``done``).
A batch found ``done`` is skipped. One found ``staged`` is finished from the staged rows, which hold
the touched partitions whole: replacing them twice is replacing them once. Before ``staged`` nothing
in the target has changed, and the batch starts anew.

The ledger is a folder of Parquet rows that are only ever added. One writer at a time, as for the
merge itself: a stream's next batch starts after the one before it is done.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom import spec
from meterloom.operators import merge as m
from meterloom.operators.audit import touched_dates_frame, touched_dates_range
from meterloom.operators.dedup import keep_latest
from meterloom.session import scratch_path
from meterloom.sinks.tables import overwrite_staging, read_or_empty, read_target, replace_partitions

STAGED, DONE = "staged", "done"
LEDGER = (
    "stream string, batch_id long, state string, target string, path string, partitions array<string>, "
    "updated long, inserted long, kept long, at timestamp"
)


def entries(spark: SparkSession, ledger: str, stream: str | None = None) -> DataFrame:
    """What the ledger holds, of one stream or all; empty if it was never written."""
    found = read_or_empty(spark, ledger, LEDGER)
    return found if stream is None else found.filter(F.col("stream") == stream)


def batches(spark: SparkSession, ledger: str, stream: str | None = None) -> DataFrame:
    """One row per batch: its newest state, the target, its partitions and counts."""
    rank = F.when(F.col("state") == DONE, 2).otherwise(1)
    columns = [c for c in entries(spark, ledger).columns if c not in ("stream", "batch_id")]
    newest = F.max(F.struct(rank.alias("rank"), F.col("at").alias("newest"), *columns)).alias("e")
    return entries(spark, ledger, stream).groupBy("stream", "batch_id").agg(newest).select(
        "stream", "batch_id", *[f"e.{c}" for c in columns]
    )


def _enter(spark: SparkSession, ledger: str, **entry) -> None:
    names = [c.strip().split(" ")[0] for c in LEDGER.split(", ")]
    row = spark.createDataFrame([tuple(entry.get(n) for n in names)], LEDGER).withColumn("at", F.current_timestamp())
    row.coalesce(1).write.mode("append").parquet(ledger)


def merge_once(
    spark: SparkSession,
    source: DataFrame,
    target: str,
    stream: str,
    batch_id: int,
    ledger: str,
    keys: Sequence[str] = tuple(spec.MERGE_KEYS),
    update_cols: Sequence[str] = tuple(spec.MERGE_UPDATE_COLUMNS),
    partition: str = spec.TARGET_PARTITION,
    labels: tuple[str, str] = spec.MERGE_LABELS,
    label_col: str | None = spec.LABEL_COLUMN,
    order: Sequence[str] | None = None,
    matched: bool = True,
    not_matched: bool = True,
    staging: str | None = None,
    on_state: Callable[[str], None] | None = None,
) -> dict[str, int]:
    """Merge ``source`` into ``target`` as batch ``batch_id`` of ``stream``, however often it is
    called; returns the batch's counts.

    The merge is that of ``write_merge``, with its parameters, in one replacement: rows without a
    partition value are inserted into the null partition, which is replaced whole like the others.
    ``source`` is read only if the batch is not staged yet. A batch that was entered for another
    target is refused. ``on_state`` is told a state once it is in the ledger.
    """
    found = batches(spark, ledger, stream).filter(F.col("batch_id") == batch_id).first()
    if found is not None and found["target"] != target:
        raise ValueError(f"batch {batch_id} of {stream} was entered for {found['target']}")
    if found is None:
        entry = _stage(
            spark, source, target, keys, update_cols, partition, labels, label_col, order, matched, not_matched,
            staging or scratch_path(spark, "ledger-merge"),
        )
        entry |= {"stream": stream, "batch_id": batch_id, "target": target}
        _enter(spark, ledger, state=STAGED, **entry)
        if on_state:
            on_state(STAGED)
    else:
        entry = {k: v for k, v in found.asDict().items() if k not in ("state", "at")}
    if found is None or found["state"] != DONE:
        if entry["partitions"]:
            replace_partitions(spark.read.parquet(entry["path"]).drop(m.OP), target, partition)
        _enter(spark, ledger, state=DONE, **entry)
        if on_state:
            on_state(DONE)
    return {"update": entry["updated"], "insert": entry["inserted"], "keep": entry["kept"]}


def _stage(
    spark, source, target, keys, update_cols, partition, labels, label_col, order, matched, not_matched, base
) -> dict:
    """Write the touched partitions as they will be; what the ledger has to know of them."""
    if order is not None:
        source = keep_latest(source, list(keys), list(order))
    staged = overwrite_staging(source, f"{base}/source")
    if order is None and not m.duplicate_keys(staged, keys).isEmpty():
        raise ValueError("the source holds more than one row for a merge key")
    before = read_target(spark, target, source, partition)
    unknown = [c for c in source.columns if c not in before.columns]
    if unknown:
        raise ValueError(f"the target has no column {', '.join(unknown)}")

    day = F.col(partition)
    dated, undated = staged.filter(day.isNotNull()), staged.filter(day.isNull())
    span = touched_dates_range(staged, partition).first()
    parts = []
    if span["dates"]:
        within = before.filter(day.between(span["first_date"], span["last_date"]))
        touched = within.join(touched_dates_frame(staged, partition), partition, "left_semi")
        parts.append(
            m.merge_upsert(
                touched.select(*before.columns), dated, keys, update_cols, labels, label_col,
                matched, not_matched, keep_op=True,
            )
        )
    if not_matched and not undated.isEmpty():
        if label_col in undated.columns:
            undated = undated.withColumn(label_col, F.lit(labels[1]))
        parts.append(before.filter(day.isNull()).withColumn(m.OP, F.lit("keep")))
        parts.append(m.in_layout(undated, before).withColumn(m.OP, F.lit("insert")))
    if not parts:
        return {"path": None, "partitions": [], "updated": 0, "inserted": 0, "kept": 0}
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    path = f"{base}/merged"
    # Rebalancing splits a day that holds most of the rows and joins small ones.
    result = overwrite_staging(merged.hint("rebalance", partition), path)
    counted = result.groupBy(partition, m.OP).count().collect()
    total = lambda op: sum(r["count"] for r in counted if r[m.OP] == op)
    listed = {r[0] for r in counted}
    return {
        "path": path,
        "partitions": sorted(str(p) for p in listed if p is not None) + ([None] if None in listed else []),
        "updated": total("update"),
        "inserted": total("insert"),
        "kept": total("keep"),
    }
