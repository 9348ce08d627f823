"""Personal data, and terms that give it away: information-theoretic sanitisation.

Base spans are found by pattern and check. Each value found is a protected entity. Entities,
terms and both together are counted by documents of the whole corpus, copies included, wherever
in the text they stand. A term's pointwise
mutual information with the entity, as a share of the entity's own information, says how much
of the entity it discloses: from ``GENERALISE`` on it is replaced by its kind, from ``REMOVE``
on it is removed, wherever it stands in a document that mentions the entity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterloom.llm.common import broadcast_if_small, stage
from meterloom.llm.spans import matches

#: The kinds in their order, each pattern as the contract has it, written so that no place is
#: tried twice: a match can only start where a run of its characters starts, or the last one ended.
KINDS = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    "card": (r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++", None),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
}
TERM = "term"
ORDER = [*KINDS, TERM]
#: Words of a term, documents needed that have term and entity.
WORD = r"\p{L}{3,}"
#: Words are no terms inside an address; the other kinds have no letters.
_WORDS = KINDS["email"][0].replace(r"\G|", "") + "|" + WORD
SUPPORT = 2
GENERALISE, REMOVE = 0.8, 0.95


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    back = F.reverse(digits)
    each = F.transform(
        F.sequence(F.lit(1), F.length(digits)),
        lambda i: F.substr(back, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1),
    )
    return F.aggregate(each, F.lit(0), lambda s, d: s + d - F.when(d > 9, 9).otherwise(0)) % 10 == 0


def _valid(kind: str) -> Column:
    value = F.col("value")
    size = F.length(_digits(value))
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (p.try_cast("int") <= 255))
    if kind == "card":
        return F.when((size >= 14) & (size <= 19), luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return (size >= 10) & (size <= 15)
    return F.lit(True)


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def base_spans(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text_hash``, ``kind``, ``start``, ``end``, ``value`` of all base spans."""
    rows = _rows(docs)
    out = None
    for kind, (pattern, gate) in KINDS.items():
        found = matches(rows, "text", pattern, ("doc_id", "text_hash"), gate=gate).filter(_valid(kind))
        found = found.select("doc_id", "text_hash", F.lit(kind).alias("kind"), "start", "end", "value")
        out = found if out is None else out.unionByName(found)
    return out.distinct()


def term_spans(
    docs: DataFrame,
    base: DataFrame,
    generalise: float = GENERALISE,
    remove: float = REMOVE,
    support: int = SUPPORT,
) -> DataFrame:
    """Terms that disclose an entity of their document: as ``base_spans``, with ``action``."""
    rows = _rows(docs)
    entities = base.select(
        "doc_id", "text_hash", "start", "end",
        F.concat_ws(":", "kind", F.when(F.col("kind").isin("card", "phone"), _digits(F.col("value"))).otherwise(F.lower("value"))).alias("entity"),
    )
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_hash"] == b["text_hash"])
    holders = broadcast_if_small(base.select("doc_id", "text_hash").distinct())
    holding = rows.join(holders, same(rows, holders), "left_semi")
    terms = stage(
        matches(holding, "text", _WORDS, ("doc_id", "text_hash"))
        .filter(~F.contains("value", F.lit("@")))
        .select("doc_id", "text_hash", "start", "end", F.lower("value").alias("term"))
        .distinct(),
        "disclosure-terms",
    )
    # Equal texts are counted once, with how many documents have them.
    total = F.lit(float(docs.count()))
    copies = stage(
        rows.join(broadcast_if_small(base.select("text_hash").distinct()), "text_hash", "left_semi")
        .groupBy("text_hash")
        .agg(F.count(F.lit(1)).alias("copies")),
        "disclosure-copies",
    )
    of_text = stage(entities.select("text_hash", "entity").distinct().join(broadcast_if_small(copies), "text_hash"), "disclosure-entities")
    n_e = of_text.groupBy("entity").agg(F.sum("copies").alias("n_e")).filter(F.col("n_e") >= support)
    words = terms.select("text_hash", "term").distinct()
    wanted = broadcast_if_small(terms.select("term").distinct())
    all_words = F.filter(F.regexp_extract_all("text", F.lit(_WORDS), F.lit(0)), lambda w: ~F.contains(w, F.lit("@")))
    present = rows.select(F.explode(F.array_distinct(F.transform(all_words, F.lower))).alias("term"))
    n_t = stage(present.join(wanted, "term").groupBy("term").agg(F.count(F.lit(1)).alias("n_t")).filter(F.col("n_t") >= support), "disclosure-counts")
    # n_et is n_e at most, so a term in more documents than this cannot reach ``generalise``.
    most = F.pow(F.col("n_e").cast("double"), F.lit(generalise)) * F.pow(total, F.lit(1 - generalise)) * (1 + 1e-9)
    pairs = (
        of_text.join(broadcast_if_small(n_e), "entity").withColumn("most", most)
        .join(words.join(broadcast_if_small(n_t), "term"), "text_hash")
        .filter(F.col("n_t") <= F.col("most"))
        .groupBy("entity", "term")
        .agg(F.sum("copies").alias("n_et"), F.max("n_e").alias("n_e"), F.max("n_t").alias("n_t"))
        .filter(F.col("n_et") >= support)
    )
    information = F.log2(total / F.col("n_e"))
    pmi = F.log2(F.col("n_et") * total / (F.col("n_e") * F.greatest("n_t", "n_et")))
    telling = stage(
        pairs.withColumn("share", F.when(information > 0, pmi / information))
        .filter(F.col("share") >= generalise)
        .select("entity", "term", "share"),
        "disclosure-telling",
    )
    there = entities.select("doc_id", "text_hash", "entity").distinct().join(telling, "entity")
    worst = there.groupBy("doc_id", "text_hash", "term").agg(F.max("share").alias("share"))
    found = terms.join(
        worst.withColumnsRenamed({"doc_id": "w_id", "text_hash": "w_hash", "term": "w_term"}),
        F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("text_hash") == F.col("w_hash")) & (F.col("term") == F.col("w_term")),
    )
    return found.select(
        "doc_id", "text_hash", F.lit(TERM).alias("kind"), "start", "end", F.col("term").alias("value"),
        F.when(F.col("share") >= remove, "remove").otherwise("generalise").alias("action"),
    )


def spans(docs: DataFrame, **limits) -> DataFrame:
    """All spans with their ``action`` (base spans are masked)."""
    base = stage(base_spans(docs), "disclosure-base")
    return base.withColumn("action", F.lit("mask")).unionByName(term_spans(docs, base, **limits))


def _listed(where: Column) -> Column:
    """kind:start:end by start, then kind in its order, joined by commas."""
    kept = F.array_sort(F.collect_list(F.when(where, F.struct("start", "number", "end", "kind"))))
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, **limits) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone``,
    ``n_term``, ``base_sha256``, ``spans``.

    Null texts are empty: no spans, the digest of nothing. Repeated rows get the same values.
    Null ids are kept. Other columns are ignored. No rows, no rows.
    """
    found = spans(docs, **limits)
    number = F.array_position(F.array(*[F.lit(k) for k in ORDER]), F.col("kind"))
    per = (
        found.withColumn("number", number)
        .groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
        .agg(
            *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in ORDER],
            _listed(F.col("kind") != TERM).alias("base"),
            _listed(F.lit(True)).alias("spans"),
        )
    )
    rows = _rows(docs).select("doc_id", "text_hash")
    joined = rows.join(
        broadcast_if_small(per, 200_000), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left"
    )
    return joined.select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in ORDER],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )


def sanitise(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with the spans of ``found`` taken out of ``text``: masked values and generalised
    terms become their kind in angle brackets, removed terms nothing. Overlapping spans are one."""
    place = ("doc_id", "text_hash")
    before = Window.partitionBy(*place).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*place).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)
    apart = F.when(F.col("start") >= F.coalesce(F.max("end").over(before), F.lit(0)), 1).otherwise(0)
    merged = (
        found.withColumn("apart", apart)
        .withColumn("n", F.sum("apart").over(upto))
        .groupBy(*place, "n")
        .agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.min_by(F.when(F.col("action") == "remove", "").otherwise(F.concat(F.lit("<"), "kind", F.lit(">"))), F.struct("start", "end")).alias("mark"),
        )
        .groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
        .agg(F.sort_array(F.collect_list(F.struct("start", "end", "mark"))).alias("_spans"))
    )
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    joined = docs.join(
        broadcast_if_small(merged, 200_000), F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64(text) == F.col("_hash")), "left"
    )
    piece = F.transform(
        F.sequence(F.lit(0), F.size("_spans")),
        lambda i: F.concat(
            F.coalesce(F.get("_spans", i - 1)["mark"], F.lit("")),
            F.substr(
                text,
                (F.coalesce(F.get("_spans", i - 1)["end"], F.lit(0)) + 1).cast("int"),
                (F.coalesce(F.get("_spans", i)["start"], F.length(text)) - F.coalesce(F.get("_spans", i - 1)["end"], F.lit(0))).cast("int"),
            ),
        ),
    )
    clean = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(F.array_join(piece, ""))
    return joined.select(*[clean.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])
