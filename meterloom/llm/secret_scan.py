"""Secret scan: wide candidates, then a random forest that drops the false findings.

A candidate is the value of a named assignment, whatever its length and signs, an issuer's own
form, or a run of at least twelve key-like characters with a digit in it. The forest weighs its length, its transitions between characters (by the letter pairs of the corpus'
frequent words, and changes of kind), how much of it dictionary words cover, the path it was
found under and the words beside it. It is trained on labelled findings.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import broadcast_if_small, stage
from meterloom.llm.spans import matches

_NAME = r"(?i:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth|bearer|credential)s?"
#: What stands between a name and its value; a lookbehind needs it bounded. Its last character is looked at first.
_ASSIGNED = rf"(?<=[=:>\s\"'`])(?<={_NAME}[\"'`\]]{{0,2}}\s{{0,3}}(?:[=:]{{1,2}}|:=|=>)\s{{0,3}}|(?i:bearer)\s{{1,3}}"
_VALUES = [
    *[rf"{_ASSIGNED.replace('|(?i:bearer)', q + '|(?i:bearer)')}{q})(?!<secret>)[^{q}\r\n]++(?={q})" for q in "\"'`"],
    rf"{_ASSIGNED})(?![\"'`]|<secret>)[^\s\"'`]*[^\s\"'`,;.:)\]}}>]",
]
_FORMS = r"AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abpr]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}"
_RUN = r"(?=[A-Za-z_+/-]*+[0-9])[A-Za-z0-9_+/-]{12,}+={0,2}"
CANDIDATE = rf"{'|'.join(_VALUES)}|(?<![A-Za-z0-9_+/-])(?:(?:{_FORMS})(?![A-Za-z0-9_+/-])|{_RUN})"
#: Words of the dictionary (the most frequent ones), and labelled findings for training, at most.
DICTIONARY, SAMPLE = 20_000, 50_000
TREES, DEPTH, SEED = 20, 6, 11
#: Words that name a secret when they stand before it; issuers' own forms; words of a test path.
NAMED = r"(?i)(pass(word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth|bearer|credential)s?\W{0,6}$"
ISSUED = rf"^({_FORMS})$"
TEST_PATH = r"(?i)(^|[/_.-])(tests?|examples?|fixtures?|docs?|samples?|mocks?)([/_.-]|$)"
FEATURES = ["length", "digits", "upper", "lower", "changes", "pair_score", "covered", "test_path", "named", "quoted", "assigned", "sentence"]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """``doc_id``, ``text_hash``, ``path``, ``start``, ``end``, ``value``, ``before``, ``after``."""
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.xxhash64(F.col(f"`{text_col}`").cast("string")).alias("text_hash"),
        F.col(f"`{path_col}`").cast("string").alias("path"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )
    return matches(rows, "text", CANDIDATE, ("doc_id", "text_hash", "path"), context=40)


def dictionary(docs: DataFrame, text_col: str = "text", size: int = DICTIONARY) -> DataFrame:
    """``word``, ``n``: the corpus' most frequent words of three letters or more, lower-cased,
    counted over all documents."""
    words = docs.select(F.explode(F.split(F.lower(F.col(f"`{text_col}`").cast("string")), r"[^\p{L}]+")).alias("word"))
    counted = words.filter(F.length("word") >= 3).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), "word").limit(size)


def letter_pairs(words: DataFrame) -> DataFrame:
    """``pair``, ``score``: log probability of the second letter after the first, over the
    dictionary's words by their counts."""
    pair = F.transform(
        F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substr(F.col("word"), i, F.lit(2))
    )
    counted = words.select(F.explode(pair).alias("pair"), "n").groupBy("pair").agg(F.sum("n").alias("n"))
    firsts = counted.groupBy(F.left("pair", F.lit(1)).alias("first")).agg(F.sum("n").alias("all"))
    return counted.join(firsts, F.left("pair", F.lit(1)) == F.col("first")).select(
        "pair", F.log(F.col("n") / F.col("all")).alias("score")
    )


def _share(pattern: str) -> Column:
    return F.regexp_count("value", F.lit(pattern)) / F.length("value")


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with ``FEATURES``. The dictionary and its letter pairs are bounded by the
    dictionary's size and broadcast."""
    distinct = found.select("value").distinct()
    parts = distinct.select(
        "value",
        F.explode_outer(
            F.filter(F.split(F.regexp_replace("value", r"([a-z])([A-Z])", "$1 $2"), r"[^A-Za-z]+"), lambda p: F.length(p) >= 3)
        ).alias("part"),
    )
    covered = (
        parts.join(F.broadcast(words.select("word", F.lit(1).alias("hit"))), F.lower("part") == F.col("word"), "left")
        .groupBy("value")
        .agg(F.sum(F.when(F.col("hit") == 1, F.length("part")).otherwise(0)).alias("in_words"))
    )
    low = F.lower("value")
    pairs = distinct.select(
        "value",
        F.explode(F.transform(F.sequence(F.lit(1), F.length("value") - 1), lambda i: F.substr(low, i, F.lit(2)))).alias("pair"),
    ).filter(F.col("pair").rlike("^[a-z]{2}$"))
    scores = (
        pairs.join(F.broadcast(letter_pairs(words)), "pair", "left")
        .groupBy("value")
        .agg(F.avg(F.coalesce("score", F.lit(-9.0))).alias("pair_score"))
    )
    kinds = F.translate("value", "BCDEFGHIJKLMNOPQRSTUVWXYZbcdefghijklmnopqrstuvwxyz123456789", "A" * 25 + "a" * 25 + "0" * 9)
    return (
        found.join(covered, "value", "left")
        .join(scores, "value", "left")
        .withColumns(
            {
                "length": F.length("value").cast("double"),
                "digits": _share("[0-9]"),
                "upper": _share("[A-Z]"),
                "lower": _share("[a-z]"),
                "changes": F.length(F.regexp_replace(kinds, r"(.)\1+", "$1")) / F.length("value"),
                "pair_score": F.coalesce("pair_score", F.lit(-9.0)),
                "covered": F.coalesce("in_words", F.lit(0)) / F.length("value"),
                "test_path": F.coalesce(F.col("path").rlike(TEST_PATH), F.lit(False)).cast("double"),
                "named": F.col("before").rlike(NAMED).cast("double"),
                "quoted": (F.col("before").rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]")).cast("double"),
                "assigned": F.col("before").rlike(r"[=:]\s*[\"'`]?$").cast("double"),
                "sentence": F.col("before").rlike(r"\p{L}[,.]?\s$").cast("double"),
            }
        )
    )


def rule_findings(found: DataFrame) -> DataFrame:
    """Labelled findings where nobody has labelled any: ``is_secret`` is true for issuers' own
    forms and for named assignments of mixed letters and digits, false for plain numbers, dates
    and word lists; other candidates stay unlabelled."""
    value = F.col("value")
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    label = (
        F.when(value.rlike(ISSUED) | (F.col("before").rlike(NAMED) & mixed), True)
        .when(value.rlike(r"^[0-9_+/=-]+$"), False)
        .when(value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"), False)
        .when(value.rlike(r"^[A-Za-z]{3,}([_/+-][A-Za-z]{3,})+[_/+-]?[0-9]{0,4}$"), False)
    )
    return found.withColumn("is_secret", label).filter("is_secret is not null").select("value", "before", "after", "path", "is_secret")


def scan(
    docs: DataFrame,
    findings: DataFrame | None = None,
    threshold: float = 0.5,
    sample: int = SAMPLE,
    dictionary_size: int = DICTIONARY,
) -> DataFrame:
    """One row per candidate: ``doc_id``, ``text_hash``, ``path``, ``start``, ``end``, ``value``,
    ``probability``, ``is_secret``.

    ``findings`` are labelled ones (``value``, ``before``, ``after``, ``path``, ``is_secret``);
    without them they are labelled by rule. At most ``sample`` of them, by a hash, train the
    forest. Findings of one kind only, or none, cannot train it: then every candidate keeps the
    share of secrets among them (1 without any), so nothing is dropped unseen. Null and empty
    texts have no candidates; repeated rows have each their own; null paths are no test paths.
    Columns other than ``doc_id``, ``text`` and ``source`` are ignored. No rows, no rows.
    """
    found = stage(candidates(docs), "secret-candidates")
    words = stage(dictionary(docs, size=dictionary_size), "secret-words")
    labelled = rule_findings(found) if findings is None else findings.select("value", "before", "after", "path", "is_secret")
    train = stage(
        with_features(
            labelled.dropna(subset=["value", "is_secret"]).distinct().orderBy(F.xxhash64("value", "before", "after", "path"), "value").limit(sample),
            words,
        )
        .select(F.xxhash64("value", "before", "after", "path").alias("h"), *FEATURES, F.col("is_secret").cast("double").alias("label"))
        .repartition(1)
        .sortWithinPartitions("h", *FEATURES, "label"),
        "secret-training",
    )
    kinds = train.agg(F.avg("label").alias("share"), F.count_distinct("label").alias("k")).first()
    marked = with_features(found, words)
    keep = ["doc_id", "text_hash", "path", "start", "end", "value"]
    if kinds["k"] < 2:
        share = 1.0 if kinds["share"] is None else float(kinds["share"])
        scored = marked.select(*keep, F.lit(share).alias("probability"))
    else:
        assemble = VectorAssembler(inputCols=FEATURES, outputCol="features")
        forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label", featuresCol="features")
        model = forest.fit(assemble.transform(train))
        scored = model.transform(assemble.transform(marked)).select(
            *keep, F.round(vector_to_array("probability")[1], 6).alias("probability")
        )
    return scored.withColumn("is_secret", F.col("probability") >= threshold)


def redact(docs: DataFrame, found: DataFrame, mark: str = "<secret>") -> DataFrame:
    """``docs`` with every found secret in ``text`` replaced by ``mark``; all columns stay.

    The spans of a text are gathered (as many as the text holds) and the pieces between them
    are joined. Texts without secrets are untouched; nothing is dropped.
    """
    spans = (
        found.filter("is_secret")
        .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "start", "end")
        .distinct()
        .groupBy("_id", "_hash")
        .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_spans"))
    )
    text = F.col("text").cast("string")
    place = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64(text) == F.col("_hash"))
    joined = docs.join(broadcast_if_small(spans, 200_000), place, "left")
    piece = F.transform(
        F.sequence(F.lit(0), F.size("_spans")),
        lambda i: F.substr(
            text,
            (F.coalesce(F.get("_spans", i - 1)["end"], F.lit(0)) + 1).cast("int"),
            (
                F.coalesce(F.get("_spans", i)["start"], F.length(text)) - F.coalesce(F.get("_spans", i - 1)["end"], F.lit(0))
            ).cast("int"),
        ),
    )
    clean = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(F.array_join(piece, mark))
    return joined.select(*[clean.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])
