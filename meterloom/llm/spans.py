"""Places of pattern matches in texts, with Spark's own expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def matches(df: DataFrame, text: str, pattern: str, keep: tuple[str, ...], context: int = 0, gate: str | None = None) -> DataFrame:
    """One row per leftmost, non-overlapping match: ``keep``, ``start``, ``end`` (code points,
    end exclusive), ``value`` and, with ``context``, that many characters of the text between
    this match and its neighbours (``before``, ``after``).

    Texts without a match (and, before that, without the plain string ``gate``) end at the
    first test. Places follow from the lengths of the pieces around the matches, summed per
    text after the pieces themselves have been cut to the context. ``keep`` should tell rows
    apart; equal rows give equal spans.
    """
    rows = df.filter(F.contains(F.col(text), F.lit(gate))) if gate else df
    rows = rows.filter(F.col(text).rlike(pattern))
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    pieces = F.split(F.col(text), pattern, -1)
    at = rows.select(*keep, found.alias("_m"), pieces.alias("_p")).withColumn("_row", F.monotonically_increasing_id())
    slim = F.transform(
        F.sequence(F.lit(0), F.size("_m") - 1),
        lambda i: F.struct(
            F.get("_m", i).alias("value"),
            F.length(F.get("_p", i)).alias("gap"),
            F.length(F.get("_m", i)).alias("size"),
            F.right(F.get("_p", i), F.lit(context)).alias("before"),
            F.left(F.get("_p", i + 1), F.lit(context)).alias("after"),
        ),
    )
    each = at.select("_row", *keep, F.posexplode(slim).alias("_i", "_s")).select("_row", "_i", *keep, "_s.*")
    upto = Window.partitionBy("_row").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("size")).over(upto)
    placed = each.withColumn("end", end.cast("long"))
    return placed.select(
        *keep, (F.col("end") - F.col("size")).alias("start"), "end", "value", *(["before", "after"] if context else [])
    )
