"""Joins of a large frame to a lookup whose size is measured, not assumed.

The lookup side is counted first (one aggregate over the lookup alone, one row back). Up to
the stated bounds it is broadcast. Beyond them both sides are shuffled on the key plus a salt,
so a key that holds a large part of the rows is spread over ``salts`` tasks. Both ways give
the same rows. The salt is a hash of row content, never a random number, so a task that is
run again after a lost executor sends every row where it went before.

The salt is not kept. A later window or aggregate on the key therefore gets a shuffle of its
own, and that leaves adaptive execution free to split a partition of this join further, by its
measured size, when one key holds so many rows that even a part of it is too large for a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 16
SALT = "_salt"


def fits_broadcast(lookup: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``lookup`` as it is now stays within the bounds (rows, and bytes of content)."""
    width = sum(
        (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in lookup.columns),
        F.lit(0).cast("long"),
    )
    size = lookup.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()
    return size["n"] <= max_rows and size["b"] <= max_bytes


def add_salt(df: DataFrame, by: Sequence[str], salts: int = SALTS) -> DataFrame:
    return df.withColumn(SALT, F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int"))


def lookup_join(
    left: DataFrame,
    lookup: DataFrame,
    keys: dict[str, str],
    spread: Sequence[str],
    how: str = "left",
    residual: Column | None = None,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """``left`` joined to ``lookup`` on ``keys`` (left column to lookup column).

    ``spread`` names left columns that differ within one key; they feed the salt.
    ``residual`` is a further condition, such as a range, checked on rows with equal keys.
    """
    on = [F.col(a) == F.col(b) for a, b in keys.items()]
    if residual is not None:
        on.append(residual)
    if fits_broadcast(lookup, max_rows, max_bytes):
        return left.join(F.broadcast(lookup), on, how)
    copies = lookup.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    # Spark's own estimate does not see the copies and might still broadcast them; the hint
    # rules that out.
    salted = add_salt(left, [*keys, *spread], salts)
    return salted.join(copies.hint("merge"), [*on, F.col(SALT) == F.col("_copy")], how).drop("_copy", SALT)


#: Width in seconds of the smallest cell, how many times as wide each next one is, and levels.
CELL, WIDER, LEVELS = 86_400, 32, 4


def cells_of(first: Column, last: Column, cell: int = CELL, wider: int = WIDER, levels: int = LEVELS) -> Column:
    """The cells (level, number) that cover a closed range of seconds, as an array of structs.

    A range goes to the first level at which it spans at most ``wider`` cells more than one, so it
    has at most ``wider + 1`` of them; the last level is one cell for all of time. An empty range,
    or one without a bound, has none.
    """
    span = last - first
    level = F.lit(levels)
    for k in reversed(range(levels)):
        level = F.when(span <= F.lit(cell * wider ** (k + 1)).cast("long"), k).otherwise(level)
    choice = F.lit(None)
    for k in range(levels):
        width = F.lit(cell * wider**k).cast("long")
        numbers = F.sequence(F.floor(first / width), F.floor(last / width))
        here = F.transform(numbers, _cell_of_level(k))
        choice = F.when(level == k, here) if k == 0 else choice.when(level == k, here)
    everything = F.array(F.struct(F.lit(levels).alias("level"), F.lit(0).cast("long").alias("cell")))
    return F.when(span >= 0, choice.otherwise(everything))


def _cell_of_level(level: int):
    return lambda number: F.struct(F.lit(level).alias("level"), number.cast("long").alias("cell"))


def cell_at(at: Column, level: Column, cell: int = CELL, wider: int = WIDER, levels: int = LEVELS) -> Column:
    """The number of the cell of a level that holds a second."""
    number = F.lit(0).cast("long")
    for k in range(levels):
        number = F.when(level == k, F.floor(at / F.lit(cell * wider**k).cast("long"))).otherwise(number)
    return number


#: Ranges up to which a key has one cell, all of time: entering a range in cells makes as many rows.
FEW_RANGES = 32


def binned_join(
    left: DataFrame,
    lookup: DataFrame,
    keys: dict[str, str],
    at: str,
    bounds: tuple[str, str],
    spread: Sequence[str],
    cell: int = CELL,
    wider: int = WIDER,
    levels: int = LEVELS,
    few: int = FEW_RANGES,
    **sizes,
) -> DataFrame:
    """Rows of ``left`` with the rows of ``lookup`` whose closed range ``bounds`` holds ``at``, for
    equal keys. Inner: rows of ``left`` without a match are not in it.

    A range is entered in every cell it covers, narrow ones in narrow cells and wide ones in wide
    cells; a row asks one cell of each level that occurs. So it is compared with ranges that
    reach into its own cell only, not with all of its key, and as a range of a level is longer
    than a cell of it (the smallest level aside), few of these do not hold it.

    A key with at most ``few`` ranges has one cell for all of time: its ranges are entered once and
    its rows ask once. Only rows of the other keys are copied for each level.
    """
    first, last = (F.col(b) for b in bounds)
    inside = F.col(at).between(first, last)
    own = list(keys.values())
    ranges = lookup.filter(first <= last).dropna(subset=own)
    dense = ranges.groupBy(*own).agg(F.count(F.lit(1)).alias("_ranges")).filter(F.col("_ranges") > few)
    dense = dense.select(*[F.col(c).alias(f"_dense_{i}") for i, c in enumerate(own)])
    if dense.isEmpty():
        return lookup_join(left, ranges, keys, [at, *spread], how="inner", residual=inside, **sizes)

    def of_dense(columns: Sequence[str], how: str) -> tuple:
        return dense, [F.col(c) == F.col(f"_dense_{i}") for i, c in enumerate(columns)], how

    entered = (
        ranges.join(*of_dense(own, "left_semi"))
        .withColumn("_in", F.explode(cells_of(first, last, cell, wider, levels)))
        .select(*lookup.columns, F.col("_in.level").alias("_level"), F.col("_in.cell").alias("_cell"))
    )
    # At most levels + 1 numbers.
    used = sorted(r[0] for r in entered.select("_level").distinct().collect())
    named = {c: f"_dense_{i}" for i, c in enumerate(keys)}
    asked = (
        lookup_join(left, dense, named, [at, *spread], how="inner", **sizes)
        .select(*left.columns)
        .withColumn("_ask", F.explode(F.array(*map(F.lit, used))))
        .withColumn("_at", cell_at(F.col(at), F.col("_ask"), cell, wider, levels))
    )
    pairs = {**keys, "_ask": "_level", "_at": "_cell"}
    by_cell = lookup_join(asked, entered, pairs, [at, *spread], how="inner", residual=inside, **sizes)
    others = ranges.join(*of_dense(own, "left_anti"))
    by_key = lookup_join(left, others, keys, [at, *spread], how="inner", residual=inside, **sizes)
    return by_cell.drop("_ask", "_at", "_level", "_cell").unionByName(by_key)


def covering_totals(
    left: DataFrame,
    lookup: DataFrame,
    keys: dict[str, str],
    at: str,
    bounds: tuple[str, str],
    total: str,
    names: tuple[str, str] = ("covering", "covering_total"),
) -> DataFrame:
    """Rows of ``left`` with how many rows of ``lookup`` (for equal keys) have a closed range
    ``bounds`` of seconds that holds ``at``, and the sum of their whole-number column ``total``.
    Inner, as ``binned_join``, whose pairs it counts without making them.

    A range adds at its first second and takes away after its last one; running sums over these
    steps, one for each key and second that occurs, are what a row finds at its own second. So
    work grows with rows and ranges, not with the pairs, which grow with the square of a key's rows.
    """
    first, last = (F.col(b) for b in bounds)
    count, summed = names
    mine, ranged = list(keys), list(keys.values())
    by = [f"_key_{i}" for i in range(len(mine))]
    step = F.inline(
        F.array(
            F.struct(first.alias("_second"), F.lit(1).cast("long").alias("_n"), F.col(total).cast("long").alias("_sum")),
            F.struct(
                (last + 1).alias("_second"), F.lit(-1).cast("long").alias("_n"), (-F.col(total).cast("long")).alias("_sum")
            ),
        )
    )
    nothing = F.lit(0).cast("long")
    steps = lookup.filter(first <= last).select(*[F.col(c).alias(b) for c, b in zip(ranged, by, strict=True)], step)
    asked = left.filter(F.col(at).isNotNull()).select(
        *[F.col(c).alias(b) for c, b in zip(mine, by, strict=True)], F.col(at).alias("_second"), nothing.alias("_n"), nothing.alias("_sum")
    )
    places = steps.unionByName(asked).dropna(subset=by).groupBy(*by, "_second").agg(
        F.sum("_n").alias("_n"), F.coalesce(F.sum("_sum"), nothing).alias("_sum")
    )
    until = Window.partitionBy(*by).orderBy("_second").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = places.select(*by, "_second", F.sum("_n").over(until).alias(count), F.sum("_sum").over(until).alias(summed))
    found = running.filter(F.col(count) > 0)
    on = [F.col(c) == F.col(b) for c, b in zip(mine, by, strict=True)]
    return left.join(found, [*on, F.col(at) == F.col("_second")]).drop(*by, "_second")
