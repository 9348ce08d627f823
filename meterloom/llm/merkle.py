"""Merkle manifest of a dataset: a digest for every row, source and for the whole, with proofs.

Rows are leaves. The leaves of a source stand in order, and runs of three become a node until one
is left; the sources' own roots, in order, become the root in the same way. A source may hold any
share of the rows, so its leaves are cut into superblocks of 3**6 consecutive ones. Each superblock
is reduced by itself to one node; those nodes are the leaves of a table 729 times smaller, which is
treated alike until every source has one node. Then the way back: a superblock is cogrouped with
the one row that says what lies outside it (the siblings on the way from its node to the root), and
one pass finishes its inner reduction, joins inner and outer proofs and folds every leaf up to the
root. Nothing grows with a source but the number of its superblocks.

Places in a source come from a range partitioning by source and order: a partition counts its rows
of each source, and the counts of the partitions before it are added.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterloom.llm.common import stage
from meterloom.operators.joins import lookup_join

FAN = 3
#: Levels within a superblock.
LEVELS = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(fields: Sequence[str], changed: Mapping[str, Column] | None = None) -> Column:
    """Digest of the fields in turn: ``-`` for null, else the count of its UTF-8 bytes, ``:``, the value."""

    def part(name: str) -> Column:
        value = (changed or {}).get(name, F.col(f"`{name}`")).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(part, fields)), 256)


def reduce_levels(nodes: Sequence[str], levels: int | None = None) -> list[list[str]]:
    """The nodes and every level above them, up to one node or for a number of levels."""
    out = [list(nodes)]
    while len(out[-1]) > 1 if levels is None else len(out) <= levels:
        below = out[-1]
        out.append([digest("".join(below[i : i + FAN])) for i in range(0, len(below), FAN)])
    return out


def siblings(levels: Sequence[Sequence[str]], place: int) -> tuple[str, str]:
    """The way up from a place: for each level two digits (siblings to the left, to the right), and
    the siblings in turn."""
    turns, proof = [], []
    for nodes in levels[:-1]:
        first = place - place % FAN
        run = nodes[first : first + FAN]
        own = place - first
        turns.append(f"{own}{len(run) - own - 1}")
        proof += run[:own] + run[own + 1 :]
        place //= FAN
    return "".join(turns), "".join(proof)


def fold(node: str, path: str, proof: str) -> str:
    """The root that ``node`` leads to along ``path`` with the siblings ``proof``."""
    at = 0
    for i in range(0, len(path), 2):
        middle = at + 64 * int(path[i])
        end = middle + 64 * int(path[i + 1])
        node = digest(proof[at:middle] + node + proof[middle:end])
        at = end
    return node


def placed(df: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``df`` with ``place`` (from 0, within a group, nulls first) and ``size`` (rows of the group).

    ``group`` is not null.
    Equal rows take places as they come. No group is gathered: see the module's text.
    """
    tied = stage(df.withColumn("_tie", F.monotonically_increasing_id()), "merkle-rows")
    keys = [F.col(c).asc_nulls_first() for c in (group, *order, "_tie")]
    numbered = tied.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_row", F.monotonically_increasing_id())
    rows = stage(numbered, "merkle-sorted").withColumn("_part", F.shiftright("_row", 33))
    counts = rows.groupBy(F.col("_part").alias("_p"), F.col(group).alias("_g")).agg(
        F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    of_group = Window.partitionBy("_g")
    before = of_group.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumns({"_before": F.coalesce(F.sum("_n").over(before), F.lit(0)), "size": F.sum("_n").over(of_group)})
    starts = stage(starts, "merkle-starts")
    joined = lookup_join(rows, starts, {"_part": "_p", group: "_g"}, ["_row"], how="inner")
    return joined.withColumn("place", F.col("_row") - F.col("_first") + F.col("_before")).select(*df.columns, "place", "size")


def _reduced(table: pd.DataFrame, block: int, levels: int) -> list[list[str]]:
    nodes = table.sort_values("place")["node"].tolist()
    return reduce_levels(nodes, None if int(table["size"].iloc[0]) <= block else levels)


def _forest(spark, nodes: DataFrame, levels: int) -> list[DataFrame]:
    """``nodes`` (group, place, size, node), the table of its superblocks' nodes, and so on up to
    one node for each group, which is the last table (group, node)."""
    block = FAN**levels

    def top(key: tuple, table: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"group": [key[0]], "place": [key[1]], "size": [-(-int(table["size"].iloc[0]) // block)], "node": _reduced(table, block, levels)[-1]})

    tables = [nodes]
    while True:
        last = tables[-1]
        up = last.select("group", F.expr(f"place div {block}").alias("block"), "place", "size", "node")
        upper = stage(
            up.groupBy("group", "block").applyInPandas(top, "group long, place long, size long, node string"), "merkle-level"
        )
        tables.append(upper)
        if upper.filter("size > 1").isEmpty():
            return tables


def _ways(tables: list[DataFrame], outer: DataFrame, levels: int) -> DataFrame:
    """From the ways of the groups' roots (group, path, proof and what is carried along) to those of
    the superblocks of the lowest table: the same columns with ``block``."""
    block = FAN**levels
    carried = [c for c in outer.columns if c not in ("group", "path", "proof")]
    ways = outer.withColumn("block", F.lit(0).cast("long"))
    schema = "group long, block long, path string, proof string" + "".join(f", {c} string" for c in carried)

    def down(key: tuple, inner: pd.DataFrame, outside: pd.DataFrame) -> pd.DataFrame:
        above, reduced = outside.iloc[0], _reduced(inner, block, levels)
        inside = [siblings(reduced, k) for k in range(len(reduced[0]))]
        found = {"path": [p + above["path"] for p, _ in inside], "proof": [s + above["proof"] for _, s in inside]}
        return pd.DataFrame({"group": key[0], "block": inner["place"].sort_values().to_numpy(), **found} | {c: above[c] for c in carried})

    for table in reversed(tables[1:-1]):
        blocks = table.withColumn("block", F.expr(f"place div {block}"))
        ways = stage(blocks.groupBy("group", "block").cogroup(ways.groupBy("group", "block")).applyInPandas(down, schema), "merkle-ways")
    return ways


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    order: str = "doc_id",
    group: str = "source",
    changed: Mapping[str, Column] | None = None,
    levels: int = LEVELS,
) -> DataFrame:
    """One row per row of ``docs``: ``order``'s column, ``leaf``, ``subroot`` (of its source),
    ``root``, ``path`` and ``proof`` (see ``siblings``), ``folded_root`` and ``verified``.

    ``changed`` are columns as they would be found on a check; ``folded_root`` is folded from the
    leaf of the changed row with the siblings of the unchanged ones, and ``verified`` says whether
    it is the root. Within a source leaves ascend by ``order``, null first; rows that share it
    stand in the order of their leaves. Rows equal in all fields have equal leaves and a place each.
    A null source is a source, first among them. Null fields count as in ``leaf``. Other columns
    are ignored, whatever their names. An empty table gives no rows.
    """
    spark = docs.sparkSession
    block = FAN**levels
    own = leaf(fields)
    rows = docs.select(
        F.col(f"`{order}`").cast("string").alias("id"),
        F.col(f"`{order}`").alias("sort"),
        F.col(f"`{group}`").alias("source"),
        own.alias("node"),
        (leaf(fields, changed) if changed else own).alias("other"),
    )
    # A key that is not null, and in the order of the sources: null, then bytewise.
    rows = rows.withColumn("source", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")))
    leaves = placed(rows, "source", ["sort", "node"])
    sources = placed(leaves.filter("place = 0").select("source", F.lit(0).cast("long").alias("all")), "all", ["source"])
    sources = stage(sources.select("source", F.col("place").alias("number"), "size"), "merkle-sources")
    numbers = sources.select(F.col("source").alias("_s"), F.col("number").alias("group"))
    numbered = lookup_join(leaves, numbers, {"source": "_s"}, ["place"], how="inner")
    leaves = stage(numbered.select("group", "place", "size", "id", "node", "other"), "merkle-leaves")

    trees = _forest(spark, leaves.select("group", "place", "size", "node"), levels)
    subroots = trees[-1].select("group", "node")
    over = sources.select(F.lit(0).cast("long").alias("group"), F.col("number").alias("place"), "size").join(
        subroots.select(F.col("group").alias("place"), "node"), "place"
    )
    over = stage(over.select("group", "place", "size", "node"), "merkle-subroots")
    upper = _forest(spark, over, levels)
    top = upper[-1].select("group", F.lit("").alias("path"), F.lit("").alias("proof"), F.col("node").alias("root"))
    # The subroots are the leaves of the upper tree: their ways are those of one-node superblocks.
    to_root = _ways([over, *upper], top, levels)
    outer = to_root.select(F.col("block").alias("group"), "path", "proof", "root").join(
        subroots.withColumnRenamed("node", "subroot"), "group"
    )
    ways = _ways(trees, stage(outer, "merkle-outer"), levels)

    def finish(key: tuple, inner: pd.DataFrame, outside: pd.DataFrame) -> pd.DataFrame:
        inner = inner.sort_values("place")
        above, reduced = outside.iloc[0], _reduced(inner, block, levels)
        found = []
        for k, other in enumerate(inner["other"]):
            path, proof = siblings(reduced, k)
            path, proof = path + above["path"], proof + above["proof"]
            found.append((path, proof, fold(other, path, proof)))
        path, proof, folded = zip(*found, strict=True)
        return pd.DataFrame(
            {"id": inner["id"].to_numpy(), "leaf": inner["node"].to_numpy(), "subroot": above["subroot"], "root": above["root"],
             "path": path, "proof": proof, "folded_root": folded}
        )

    out = (
        leaves.withColumn("block", F.expr(f"place div {block}"))
        .groupBy("group", "block")
        .cogroup(ways.groupBy("group", "block"))
        .applyInPandas(finish, "id string, leaf string, subroot string, root string, path string, proof string, folded_root string")
    )
    kind = docs.schema[order].dataType
    return out.select(
        F.col("id").cast(kind).alias(order),
        "leaf", "subroot", "root", "path", "proof", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )
