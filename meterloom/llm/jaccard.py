"""Size-aware heavy-light similarity join on sets of word shingles, and the groups it forms.

Sets that reach the similarity have many members in common, so under any fixed order of all
members they share one of each set's first ``n - ceil(t n) + 1`` members, and two of the first
``n - ceil(t n) + 2``. Small (light) sets enumerate the two-member subsets of that longer
prefix and meet on equal subsets; large (heavy) sets meet on the inverted lists of the single
members of the shorter one. Sets just below the boundary do both, so that they also meet large
ones. The boundary is the size from which the subsets outnumber the expected list entries; the
mean length of a list comes from the counts, over all documents, of a fixed share of all members.
The order puts frequent members last; a frequency only affects cost, never the result.

Large groups are joined without forming all their pairs. Twice, each list compares its members
with one centre, the member that shares most lists with others (the origin of a group of copies,
mostly), and leaves the centre out from then on; connected sets are one component, and a list is
left out when all its members are in one. In what remains, the members outside a list's largest
component are compared with all others of other components. So every pair that is not in one
component by then shares a list and is compared there, and no link between different components
is lost. A sketch of each set rules out most pairs that are far apart; every link is verified on
the whole sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterloom.llm.common import bounded_batches, broadcast_if_small, drop_tables, stage, stage_bucketed
from meterloom.llm.components import components
from meterloom.operators.joins import lookup_join

WORDS = 5
PERCENT = 75
#: Members ordered by frequency; the rest is ordered by hash. Bounds a broadcast (2 x 8 bytes each).
ORDERED = 200_000
#: One in so many members is counted over all documents, to know how long lists are.
COUNTED = 64
#: Words whose hash a task remembers before it starts anew.
REMEMBERED = 150_000
#: Characters of text that a task holds as sets at once.
SLICE = 6_000_000
#: 64-bit words of a set's sketch, for up to 1,024 members; doubled with them, so that the sketches of
#: long sets are not full and rule pairs out as well.
SKETCH = 16
_M = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, hashes: _Hashes, width: int = WORDS) -> np.ndarray:
    """Distinct shingles as sorted 64-bit hashes. ``bytes`` methods treat ASCII only, which is
    what the words are defined by: A-Z in lower case, split at space and \\x09-\\x0d."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    k = min(width, len(h))
    out = h[: len(h) - k + 1].copy()
    for j in range(1, k):
        out = out * _M + h[j : len(h) - k + 1 + j]
    return np.unique(_mix(out + np.uint64(k)))


def _digest(members: np.ndarray) -> int:
    """The class of all documents with this set (64 bits, as the shingles themselves)."""
    return xxhash.xxh3_64_intdigest(members.tobytes()) - (1 << 63)


def _sketch(members: np.ndarray) -> list[int]:
    """A bit for every member, by its hash. A bit of one set that another lacks stands for a
    member, at least, that the other lacks. Sizes are powers of two, so that a bit's place in a
    small sketch is the rest of its place in a large one."""
    size = max(64 * SKETCH, 1 << min((len(members) - 1).bit_length(), 24))
    bits = np.zeros(size, np.uint8)
    bits[(members >> np.uint64(40)) % np.uint64(size)] = 1
    return np.packbits(bits).view(np.int64).tolist()


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs of bounded text, so that memory follows the text, not rows."""
    for batch in batches:
        start = size = 0
        for i, text in enumerate(batch.column(1)):
            size += len(text.as_buffer()) if text.is_valid else 0
            if size >= SLICE:
                yield batch.slice(start, i + 1 - start)
                start, size = i + 1, 0
        if start < len(batch):
            yield batch.slice(start)


def _profile(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """A row per document, and a row per shingle that repeats within a batch or is counted."""
    hashes = _Hashes()
    for batch in _slices(batches):
        ids, texts = batch.column(0), batch.column(1)
        n = np.zeros(len(ids), np.int64)
        classes: list[int | None] = []
        sketches: list[list[int] | None] = []
        seen: dict[int, np.ndarray] = {}
        for i, text in enumerate(texts):
            members = shingle_set(text.as_py(), hashes, width)
            n[i] = len(members)
            classes.append(_digest(members) if len(members) else None)
            sketches.append(_sketch(members) if len(members) else None)
            if len(members):
                seen[classes[-1]] = members
        values, counts = (
            np.unique(np.concatenate(list(seen.values())), return_counts=True) if seen else (np.empty(0, np.uint64),) * 2
        )
        some = (counts >= 2) | (values % np.uint64(COUNTED) == 0)
        k = int(some.sum())
        sizes = [len(ids), k]
        pad = lambda values, at, kind: pa.concat_arrays(
            [pa.nulls(s, kind) if i != at else pa.array(values, kind) for i, s in enumerate(sizes)]
        )
        yield pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays([ids.cast(pa.int64()), pa.nulls(k, pa.int64())]),
                pad(n, 0, pa.int64()),
                pad(classes, 0, pa.int64()),
                pad(sketches, 0, pa.list_(pa.int64())),
                pad(_signed(values[some]), 1, pa.int64()),
                pad(counts[some].astype(np.int64), 1, pa.int64()),
            ],
            names=["doc_id", "n", "cls", "sketch", "shingle", "df"],
        )


def boundary(list_length: float, percent: int = PERCENT, most: int = 1000) -> int:
    """Largest size at which enumerating subsets costs no more than scanning lists of the given
    mean length (met by a random member). 0: no set is small."""
    best = 0
    for n in range(3, most):
        p = n - -(-percent * n // 100) + 1
        if math.comb(p + 1, 2) <= p * list_length:
            best = n
        elif p > 2 * list_length + 2:
            break
    return best


def _keys(batches, width: int, percent: int, light: int, common) -> Iterator[pa.RecordBatch]:
    """Posting rows: key, class, set size, place of the key's first member in the order."""
    hashes = _Hashes()
    values, frequency = common.value
    for batch in _slices(batches):
        seen: set[int] = set()
        out: list[tuple] = []
        for text in batch.column(1):
            members = shingle_set(text.as_py(), hashes, width)
            n = len(members)
            if n < 3:  # one or two members: only an equal set reaches the similarity
                continue
            cls = _digest(members)
            if cls in seen:
                continue
            seen.add(cls)
            p = n - -(-percent * n // 100) + 1
            if len(values):
                at = np.minimum(np.searchsorted(values, members), len(values) - 1)
                rank = np.where(values[at] == members, frequency[at], 0)
                if rank.any():
                    members = members[np.lexsort((members, rank))]
            if n > light or 100 * n >= percent * light:
                out.append((members[:p], cls, n, np.arange(p)))
            if n <= light:
                i, j = np.triu_indices(min(p + 1, n), 1)
                out.append((_mix(members[i] * _M + members[j]), cls, n, i))
        if not out:
            continue
        lengths = [len(x[0]) for x in out]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(_signed(np.concatenate([x[0] for x in out]))),
                pa.array(np.repeat(np.array([x[1] for x in out], np.int64), lengths)),
                pa.array(np.repeat(np.array([x[2] for x in out], np.int32), lengths)),
                pa.array(np.concatenate([x[3] for x in out]).astype(np.int32)),
            ],
            names=["key", "cls", "n", "pos"],
        )


def _sets(batches, width: int) -> Iterator[pa.RecordBatch]:
    hashes = _Hashes()
    for batch in _slices(batches):
        found = [x for text in batch.column(1) if len(x := shingle_set(text.as_py(), hashes, width))]
        if found:
            ends = np.cumsum([0] + [len(x) for x in found]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_digest(x) for x in found], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(_signed(np.concatenate(found)))),
                ],
                names=["cls", "members"],
            )


def _reach(percent: int, na: str, nb: str, pa_: str, pb: str):
    """Sizes and places that still allow the similarity (places: of the first common member)."""
    return F.expr(
        f"100 * least({na}, {nb}) >= {percent} * greatest({na}, {nb}) AND "
        f"{100 + percent}L * least({na} - {pa_}, {nb} - {pb}) >= {percent}L * ({na} + {nb})"
    )


def jaccard_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WORDS,
    percent: int = PERCENT,
    ordered: int = ORDERED,
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id``.

    Documents link when 100 * intersection >= ``percent`` * union of their shingle sets. A
    document with fewer than ``width`` words has one shingle, its whole sequence. Null or empty
    texts, and texts of white space, have none and link with nothing: their component is
    themselves. Equal sets are one class and always linked. A row without an id links with
    nothing and has no component. Repeated rows are rows of their own with the same values.
    Other columns are ignored. An empty table gives no rows. ``percent`` is above 50.
    """
    bounded_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    profile = stage(
        source.mapInArrow(
            lambda batches: _profile(batches, width),
            "doc_id long, n long, cls long, sketch array<long>, shingle long, df long",
        ),
        "jaccard-profile",
    )
    rows = profile.filter("n is not null").select("doc_id", F.col("n").alias("n_shingles"), "cls")
    classes = stage(
        profile.dropna(subset=["doc_id", "cls"])
        .groupBy("cls")
        .agg(F.min(F.struct("doc_id", "n", "sketch")).alias("f"))
        .select("cls", F.col("f.doc_id").alias("first_id"), F.col("f.n").alias("n"), F.col("f.sketch").alias("sketch")),
        "jaccard-classes",
    )

    spark = docs.sparkSession
    counts = stage(
        profile.filter("shingle is not null").groupBy("shingle").agg(F.sum("df").alias("df")).filter(f"df >= 8 OR shingle % {COUNTED} = 0"),
        "jaccard-counts",
    )
    common, floor = _most_frequent(counts, ordered)
    # Frequent members stand last and hardly start a list, so the lists met are those of the others.
    # Signed remainders are 0 where the unsigned ones are, for a power of two.
    counted = counts.filter(f"shingle % {COUNTED} = 0").filter(F.lit(True) if floor is None else F.col("df") < floor)
    sums = counted.agg(F.sum("df"), F.sum(F.col("df").cast("double") ** 2)).first()
    light = boundary(sums[1] / sums[0], percent) if sums[0] else 0
    common = common.toPandas()
    values = common["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(values)
    shared = spark.sparkContext.broadcast((values[order], common["df"].to_numpy(np.int64)[order]))

    named = source.dropna()
    postings = named.mapInArrow(
        lambda batches: _keys(batches, width, percent, light, shared), "key long, cls long, n int, pos int"
    )
    per_key = Window.partitionBy("key")
    # Most members occur in one set only; their lists end here, before anything is joined.
    made: list[str] = []
    lists = stage_bucketed(
        postings.withColumns(
            {"lo": F.min("cls").over(per_key), "hi": F.max("cls").over(per_key), "length": F.count(F.lit(1)).over(per_key)}
        )
        .filter("lo < hi")
        .drop("lo", "hi")
        .dropDuplicates(["key", "cls"]),
        "jaccard_lists",
        "key",
        names=made,
    )
    degrees = lists.groupBy("cls").agg(F.sum("length").alias("degree"))
    state = stage(degrees.withColumn("comp", F.col("cls")), "jaccard-state")

    links = None
    for turn in range(3):
        if links is not None:
            label = components(links).select(F.col("node").alias("cls"), "label")
            state = stage(
                state.join(label, "cls", "left").select("cls", "degree", F.coalesce("label", "comp").alias("comp")), "jaccard-state"
            )
        pairs, lists = _list_pairs(lists, state, turn, percent)
        good = _verified(pairs, named, classes, width, percent)
        links = good if links is None else links.unionByName(good)
    drop_tables(spark, made)

    ids = components(links).withColumnRenamed("node", "cls")
    groups = classes.join(ids, "cls", "left").select(
        "cls", "first_id", F.coalesce("label", "cls").alias("label")
    )
    firsts = groups.groupBy("label").agg(F.min("first_id").alias("component_id"))
    # Only a label that several classes share can differ from the class's own first document.
    shared_labels = groups.filter("label <> cls").select("label").distinct()
    of_label = stage(firsts.join(shared_labels, "label", "left_semi"), "jaccard-components")
    of_class = lookup_join(
        groups, of_label.select(F.col("label").alias("_label"), "component_id"), {"label": "_label"}, ["cls"]
    ).select("cls", F.coalesce("component_id", "first_id").alias("component_id"))
    return rows.join(of_class, "cls", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def _most_frequent(counts: DataFrame, most: int) -> tuple[DataFrame, int | None]:
    """At most ``most`` of the frequent shingles, all from a frequency on, and that frequency. It is
    found from a histogram of a few hundred steps."""
    step = F.floor(F.log2("df") * 8).alias("step")
    kept, floor = 0, None
    for row in counts.filter("df >= 8").groupBy(step).agg(F.count(F.lit(1)).alias("n"), F.min("df").alias("low")).orderBy(F.desc("step")).collect():
        kept += row["n"]
        if kept > most:
            break
        floor = row["low"]
    return counts.filter(F.lit(False) if floor is None else F.col("df") >= floor), floor


def _list_pairs(lists: DataFrame, state: DataFrame, turn: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of one list in different components, and what remains of the lists after they are
    compared. Turns 0 and 1 pair a list's centre with the others; the last turn pairs all that are
    outside the list's largest component with all others."""
    key = Window.partitionBy("key")
    known = state.withColumnRenamed("cls", "_cls")
    placed = lists.select("key", "cls", "n", "pos").join(broadcast_if_small(known), F.col("cls") == F.col("_cls")).drop("_cls")
    open_ = placed.withColumns({"lo": F.min("comp").over(key), "hi": F.max("comp").over(key)}).filter("lo < hi").drop("lo", "hi")
    if turn < 2:
        centre = F.max(F.struct("degree", "cls", "n", "pos", "comp")).over(key)
        open_ = stage(open_.withColumn("c", centre), "jaccard-open")
        rest = open_.filter("c.cls <> cls")
        found = rest.filter((F.col("c.comp") != F.col("comp")) & _reach(percent, "c.n", "n", "c.pos", "pos"))
        pair = found.select(F.least("c.cls", "cls").alias("a"), F.greatest("c.cls", "cls").alias("b"))
    else:
        rest = stage(open_, "jaccard-open")
        sizes = rest.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("many"))
        largest = sizes.groupBy("key").agg(F.max(F.struct("many", "comp"))["comp"].alias("main"))
        own = rest.join(largest, "key")
        x, y = own.filter("comp <> main").alias("x"), own.alias("y")
        pair = x.join(
            y,
            (F.col("x.key") == F.col("y.key"))
            & (F.col("x.comp") != F.col("y.comp"))
            & ((F.col("x.comp") < F.col("y.comp")) | (F.col("y.comp") == F.col("y.main")))
            & _reach(percent, "x.n", "y.n", "x.pos", "y.pos"),
        ).select(F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b"))
    return stage(pair.distinct(), "jaccard-pairs"), rest


def _possible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sketches do not rule the similarity out: a set has at most as many members
    in common with the other one as are left after the bits that the other lacks. Of two sketches
    the smaller one is laid against each part of the larger; only what it lacks is counted then."""
    of = lambda end: classes.select(F.col("cls").alias(end), F.col("n").alias(f"n{end}"), F.col("sketch").alias(f"s{end}"))

    def lacking(one: str, other: str):
        words = F.transform(one, lambda x, i: F.bit_count(x.bitwiseAND(F.bitwise_not(F.get(other, i % F.size(other))))))
        return F.when(F.size(one) >= F.size(other), F.aggregate(words, F.lit(0), lambda total, n: total + n)).otherwise(0)

    common = F.least(F.col("na") - lacking("sa", "sb"), F.col("nb") - lacking("sb", "sa"))
    return pairs.join(of("a"), "a").join(of("b"), "b").filter((100 + percent) * common >= percent * (F.col("na") + F.col("nb"))).select("a", "b")


def _verified(pairs: DataFrame, named: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose whole sets reach the similarity. Sets are made for the classes in pairs that
    their sketches leave possible, and always shuffled, so that the work is alike at every size."""
    pairs = stage(_possible(pairs, classes, percent), "jaccard-possible")
    wanted = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).distinct()
    first = stage(wanted.join(classes, "cls").select(F.col("first_id").alias("doc_id")).distinct(), "jaccard-wanted")
    texts = named.join(broadcast_if_small(first), "doc_id", "left_semi")
    # Rows that share an id bring sets of other classes, or one more than once.
    sets = texts.select("doc_id", "text").mapInArrow(lambda b: _sets(b, width), "cls long, members array<long>")
    joined = (
        pairs.join(sets.select(F.col("cls").alias("a"), F.col("members").alias("ma")).hint("merge"), "a")
        .join(sets.select(F.col("cls").alias("b"), F.col("members").alias("mb")).hint("merge"), "b")
    )
    both = F.size(F.array_intersect("ma", "mb"))
    union = F.size("ma") + F.size("mb") - both
    return stage(joined.filter(100 * both >= percent * union).select("a", "b").distinct(), "jaccard-links")
