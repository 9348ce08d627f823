"""Mixing sources to target weights by temperature, realised as budgeted block permutations.

Weights are the sources' token shares raised to an exponent and normalised. The exponent is
found by bisection: the largest whose weights reach an entropy, or the smallest that keeps the
most repeated source within a limit. A source then gets its share of the token budget as whole
epochs and a rest. Its documents lie in blocks by hash; an epoch is a permutation of the blocks
and of the documents in each. Whole blocks fill the rest, and of the one block that the budget
cuts, documents in permuted order. All sums are made per block first, so a source that holds
most of the rows is summed and cut like any other, in ``blocks`` parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterloom.llm.common import broadcast_if_small, stage

#: Halvings of the exponent's interval, and how many of them one job evaluates at once.
HALVINGS, AT_ONCE = 24, 4
BLOCKS = 1024


def token_count(text: Column) -> Column:
    """Words between white space; a text without words counts one, so that every row has a place."""
    return F.greatest(F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)), F.lit(1)).cast("long")


def temperature(sources: DataFrame, entropy: float | None, repetition: float | None, budget: float | None) -> float:
    """The exponent for ``sources`` (``tokens`` of each), between 0 and 1.

    ``entropy`` is a share of the entropy of equal weights; the largest exponent that reaches
    it is taken. ``repetition`` limits how often a source's tokens occur under ``budget`` (or
    under the smallest budget that holds every source once); the smallest exponent within it is
    taken, and it wins over the entropy. A limit that no exponent keeps gives 1.
    """

    def largest_true(ok: Column) -> float:
        low, high = 0.0, 1.0
        for _ in range(HALVINGS // AT_ONCE):
            steps = 2**AT_ONCE
            grid = [low + (high - low) * k / steps for k in range(steps + 1)]
            points = F.explode(F.array(*[F.lit(g) for g in grid])).alias("x")
            share = F.col("tokens") / F.col("all_tokens")
            rows = sources.select(points, share.alias("p")).withColumn("u", F.pow("p", "x"))
            held = (
                rows.groupBy("x")
                .agg(
                    F.count(F.lit(1)).alias("k"),
                    F.sum("u").alias("z"),
                    F.sum(F.col("u") * F.log("p")).alias("ulogp"),
                    F.max(F.col("u") / F.col("p")).alias("most"),
                    F.min(F.col("u") / F.col("p")).alias("least"),
                )
                .select("x", ok.alias("ok"))
                .collect()
            )
            good = {r["x"]: r["ok"] for r in held}
            at = max((k for k, g in enumerate(grid) if good[g]), default=None)
            if at is None:
                return low
            if at == steps:
                return high
            low, high = grid[at], grid[at + 1]
        return low

    exponent = 1.0
    if entropy is not None:
        # H = ln z - x * sum(u ln p) / z falls as the exponent grows.
        h = F.log("z") - F.col("x") * F.col("ulogp") / F.col("z")
        exponent = largest_true(h >= F.lit(entropy) * F.log(F.col("k")) - F.lit(1e-12))
    if repetition is not None:
        # Repetitions fall as the exponent grows to 1, so look for the largest that breaks the limit.
        if budget is None:
            most = F.col("most") / F.col("least")
        else:
            most = F.lit(float(budget)) * F.col("most") / F.col("z") / F.lit(_all(sources))
        broken = largest_true(most > F.lit(repetition) * F.lit(1 + 1e-9))
        within = min(1.0, broken + 2.0**-HALVINGS) if broken > 0 else 0.0
        first = sources.agg(F.min("tokens").alias("a"), F.max("tokens").alias("b"), F.count(F.lit(1)).alias("k")).first()
        if broken == 0.0 and budget is None and first["b"] / first["a"] > repetition:
            within = 2.0**-HALVINGS
        exponent = max(exponent if entropy is not None else 0.0, within)
    return exponent


def _all(sources: DataFrame) -> float:
    return float(sources.agg(F.max("all_tokens")).first()[0])


def mix(
    docs: DataFrame,
    entropy: float | None = None,
    repetition: float | None = None,
    budget: int | None = None,
    seed: int = 7,
    blocks: int = BLOCKS,
    source_col: str = "source",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs``, each row as often as the mixture takes it, with ``_epoch``, ``_block``,
    ``_place`` (sort by the three for the mixed order), ``_tokens`` and ``_weight``.

    Without ``budget`` the smallest is taken that holds every source once, so no row is lost.
    The realised tokens of a source stay within its share of the budget, short of it by less
    than one document (equal rows are taken together). Null sources are one source. Null and
    empty texts count one token. No rows, no rows. Columns of ``docs`` keep their values;
    the five added names start with an underscore and replace columns of those names.
    """
    source = F.col(f"`{source_col}`")
    docs = docs.drop("_epoch", "_block", "_place", "_tokens", "_weight")
    identity = F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    in_block = F.pmod(identity, F.lit(blocks)).cast("int")
    place = F.xxhash64(F.lit(seed + 1), identity)

    held = stage(
        docs.select(source.alias("_source"), in_block.alias("_block"), token_count(F.col(f"`{text_col}`")).alias("_tokens"))
        .groupBy("_source", "_block")
        .agg(F.sum("_tokens").alias("_tokens")),
        "mix-blocks",
    )
    totals = held.groupBy("_source").agg(F.sum("_tokens").alias("tokens"))
    every = totals.agg(F.sum("tokens")).first()[0]
    if every is None:
        empty = docs.limit(0)
        return empty.withColumns(
            {
                "_epoch": F.lit(0).cast("long"), "_block": F.lit(0), "_place": F.lit(0).cast("long"),
                "_tokens": F.lit(0).cast("long"), "_weight": F.lit(0.0),
            }
        )
    sources = stage(totals.withColumn("all_tokens", F.lit(every)), "mix-sources")
    x = temperature(sources, entropy, repetition, budget)

    raised = sources.withColumn("u", F.pow(F.col("tokens") / F.col("all_tokens"), F.lit(x)))
    sums = raised.agg(F.sum("u").alias("z"), F.max(F.col("tokens") / F.col("u")).alias("once")).first()
    spent = float(budget) if budget is not None else float(sums["once"]) * float(sums["z"])
    share = raised.withColumn("_weight", F.col("u") / F.lit(sums["z"])).withColumn(
        "b", F.floor(F.col("_weight") * F.lit(spent) * F.lit(1 + 1e-12) + F.lit(1e-6))
    )
    plan = share.select(
        "_source",
        "_weight",
        F.floor(F.col("b") / F.col("tokens")).alias("_full"),
        (F.col("b") - F.floor(F.col("b") / F.col("tokens")) * F.col("tokens")).cast("long").alias("_rest"),
    )
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    small = plan.withColumnRenamed("_source", "_plan_source")
    order = F.xxhash64(F.lit(seed), F.col("_full"), F.col("_block"))
    before = Window.partitionBy("_source").orderBy(order, "_block").rowsBetween(Window.unboundedPreceding, -1)
    cut = stage(
        held.join(broadcast_if_small(small), same("_source", "_plan_source"))
        .withColumn("_start", F.coalesce(F.sum("_tokens").over(before), F.lit(0)))
        .select("_source", "_block", "_tokens", "_weight", "_full", "_rest", "_start"),
        "mix-cut",
    )
    # The one block per source that the budget cuts: how far its permuted documents fit.
    torn = cut.filter("_start < _rest AND _start + _tokens > _rest").select(
        F.col("_source").alias("_t_source"), F.col("_block").alias("_t_block"), (F.col("_rest") - F.col("_start")).alias("_left")
    )
    inside = (
        docs.select(source.alias("_source"), in_block.alias("_block"), place.alias("_place"), F.col(f"`{text_col}`").alias("_text"))
        .join(broadcast_if_small(torn), same("_source", "_t_source") & (F.col("_block") == F.col("_t_block")))
        .groupBy("_source", "_block", "_place")
        .agg(F.sum(token_count(F.col("_text"))).alias("_n"), F.first("_left").alias("_left"))
    )
    running = Window.partitionBy("_source", "_block").orderBy("_place")
    upto = (
        inside.withColumn("_sum", F.sum("_n").over(running))
        .filter("_sum <= _left")
        .groupBy(F.col("_source").alias("_u_source"), F.col("_block").alias("_u_block"))
        .agg(F.max("_place").alias("_upto"))
    )
    decided = stage(
        cut.join(broadcast_if_small(upto), same("_source", "_u_source") & (F.col("_block") == F.col("_u_block")), "left").select(
            F.col("_source").alias("_d_source"),
            F.col("_block").alias("_d_block"),
            "_weight",
            "_full",
            F.when(F.col("_start") + F.col("_tokens") <= F.col("_rest"), F.lit(2**63 - 1)).otherwise(F.col("_upto")).alias("_upto"),
        ),
        "mix-decided",
    )
    placed = docs.withColumns({"_block": in_block, "_place": place}).join(
        broadcast_if_small(decided), source.eqNullSafe(F.col("_d_source")) & (F.col("_block") == F.col("_d_block"))
    )
    copies = F.col("_full") + F.when(F.col("_place") <= F.col("_upto"), 1).otherwise(0)
    return (
        placed.filter(copies > 0)
        .withColumn("_epoch", F.explode(F.sequence(F.lit(0).cast("long"), (copies - 1).cast("long"))))
        .withColumn("_tokens", token_count(F.col(f"`{text_col}`")))
        .withColumn("_place", F.xxhash64("_place", "_epoch"))
        .withColumn("_block", F.xxhash64(F.lit(seed), F.col("_epoch"), F.col("_block")))
        .select(*[F.col(f"`{c}`") for c in docs.columns], "_epoch", "_block", "_place", "_tokens", "_weight")
    )
