"""Vector best-fit packing of tokenised documents into sequences of bounded capacity.

A document longer than a sequence is cut from its end into whole sequences, so that only its
first piece may be shorter; whole pieces are sequences as they are. The short pieces are dealt
at random into groups of bounded size, and each group is packed by itself, largest first: a bin
has three residual capacities (tokens, documents, attention cost, which is the sum of squared
lengths), a piece may only enter a bin that has room in all three, and among those it takes the
one that fits best, by the norm of what would remain or by the weighted dot product. Groups hold
many thousand pieces each, so the sequences that stay partly empty at the end of a group are few.

Only keys and lengths are shuffled to be packed. The ids stay where they were written and meet
their places by a join on the piece's key, which is unique, so no source or document is hot.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import bounded_batches, stage

TOKENS = 2048
#: Pieces that one group should hold.
GROUP = 32_768
#: Weights of the residual tokens, documents and attention cost, each relative to its capacity.
WEIGHTS = (1.0, 0.01, 0.01)
#: Bytes of ids after which rows are handed on.
HAND_ON = 4 << 20
_PIECES = "key long, doc_id long, piece int, start long, length int, ids binary"
#: How the vocabulary's texts are split before they are merged (fixed value), and the same for texts
#: without two white space characters in a row, which needs no look ahead.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SINGLE = PATTERN.replace(r"\s+(?!\S)|", "")
_OTHER_SPACE = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_IN_A_ROW = ("  ", "\n\n", " \n", "\n ", *_OTHER_SPACE)


class _Encoder:
    """Ids of texts by a tokenizer file.

    Its merges are applied by a second implementation, which is several times as quick and gives
    the same ids (a test compares them). Texts with letters beyond the Latin ones, for which the
    two may know other versions of Unicode, and texts that hold one of the file's added tokens
    are left to the tokenizer itself.
    """

    def __init__(self, definition: str):
        import tiktoken
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(definition)
        self.added = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
        byte = _byte_of()
        ranks = {bytes(map(byte.__getitem__, t)): i for t, i in tokenizer.get_vocab(False).items() if t not in self.added}
        made = {p: tiktoken.Encoding("packing", pat_str=p, mergeable_ranks=ranks, special_tokens={}) for p in (SINGLE, PATTERN)}
        self.single, self.quick = (made[p].encode_ordinary for p in (SINGLE, PATTERN))
        self.slow = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
        self.beyond = re.compile("[\u0250-\U0010ffff]").search

    def __call__(self, text: str) -> list[int]:
        if any(token in text for token in self.added) or not text.isascii() and self.beyond(text):
            return self.slow(text)
        return self.quick(text) if any(c in text for c in _IN_A_ROW) else self.single(text)


def _byte_of() -> dict[str, int]:
    """The byte that a character of a byte-level vocabulary stands for: printable Latin-1 for itself,
    the other bytes, in order, as the characters from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


_encoders: dict[int, _Encoder] = {}


def _encoder(definition: str) -> _Encoder:
    """The worker's own, kept for its next tasks."""
    if hash(definition) not in _encoders:
        _encoders.clear()
        _encoders[hash(definition)] = _Encoder(definition)
    return _encoders[hash(definition)]


def _pieces(batches: Iterator[pa.RecordBatch], definition, tokens: int, end_id: int) -> Iterator[pa.RecordBatch]:
    encoder, end = _encoder(definition.value), np.array([end_id], "<u4").tobytes()
    number = TaskContext.get().partitionId() << 40  # tells pieces apart, also when the task is run again
    rows: list[tuple] = []
    held = 0

    def batch():
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)],
            names=["key", "doc_id", "piece", "start", "length", "ids"],
        )

    for given in batches:
        for doc, text in zip(given.column(0).to_pylist(), given.column(1), strict=True):
            ids = np.array(encoder(text.as_py() or ""), "<u4").tobytes() + end
            count, at = len(ids) // 4, 0
            for piece in range(-(-count // tokens)):
                stop = at + (count % tokens or tokens if piece == 0 else tokens)
                rows.append((number, doc, piece, at, stop - at, ids[4 * at : 4 * stop]))
                held += 4 * (stop - at) + 64
                number, at = number + 1, stop
                if held >= HAND_ON:
                    yield batch()
                    rows, held = [], 0
    if rows:
        yield batch()


def best_fit(lengths: np.ndarray, capacity: Sequence[float], weights: Sequence[float] = WEIGHTS, by: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length. ``capacity``: tokens, documents and attention cost of a bin.

    ``by="norm"`` takes the bin with the least weighted norm of what remains of the capacities
    after the piece; ``by="dot"`` the one with the largest weighted dot product of piece and
    residual, relative to the residual's squared norm. Ties go to the older bin. A piece that
    exceeds a capacity by itself has a bin of its own.
    """
    if by not in ("norm", "dot"):
        raise ValueError("by is norm or dot")
    cap, weight = np.asarray(capacity, np.float64), np.asarray(weights, np.float64)
    sizes = np.asarray(lengths, np.float64)
    items = np.stack([sizes, np.ones(len(sizes)), sizes**2], 1)
    order = np.argsort(-sizes, kind="stable")
    left = np.empty((3, len(sizes)))  # residuals of the open bins, a row for each capacity
    number = np.empty(len(sizes), np.int64)
    used = np.zeros(len(sizes), np.int64)
    place, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    smallest = items[order[-1]] if len(order) else None
    scale = (weight / cap**2)[:, None]
    opened = bins = 0
    for turn, i in enumerate(order):
        item = items[i]
        if turn % 512 == 511:  # forget bins that not even the smallest piece enters
            alive = np.flatnonzero((left[:, :opened] >= smallest[:, None]).all(0))
            left[:, : len(alive)], number[: len(alive)] = left[:, alive], number[alive]
            opened = len(alive)
        room = left[:, :opened]
        fits = np.flatnonzero((room[0] >= item[0]) & (room[1] >= item[1]) & (room[2] >= item[2]))
        if len(fits):
            here = room[:, fits]
            if by == "norm":
                best = fits[np.argmin((scale * (here - item[:, None]) ** 2).sum(0))]
            else:
                best = fits[np.argmax((scale * here * item[:, None]).sum(0) / (scale * here**2).sum(0))]
        else:
            best, number[opened] = opened, bins
            left[:, opened] = cap
            opened, bins = opened + 1, bins + 1
        left[:, best] -= item
        place[i] = number[best]
        offset[i] = used[place[i]]
        used[place[i]] += int(sizes[i])
    return place, offset


def _pack_group(table: pa.Table, capacity, weights, by: str) -> pa.Table:
    """A sequence goes by the key of its first piece."""
    table = table.sort_by("key")  # the same bins whichever order the rows came in
    keys = table.column("key").to_numpy()
    bins, offset = best_fit(table.column("length").to_numpy(), capacity, weights, by)
    first = np.empty(bins.max() + 1, np.int64)
    first[bins[offset == 0]] = keys[offset == 0]
    return pa.table({"key": keys, "sequence_id": first[bins], "offset": offset})


def tokenize(docs: DataFrame, tokenizer: str, tokens: int = TOKENS, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of every text: ``key`` (unique), ``doc_id``, ``piece``, ``start``, ``length`` and ``ids`` (binary)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    with open(tokenizer, encoding="utf-8") as file:
        definition = spark.sparkContext.broadcast(file.read())
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(lambda batches: _pieces(batches, definition, tokens, end_id), _PIECES)


def pack(
    docs: DataFrame,
    tokenizer: str,
    tokens: int = TOKENS,
    documents: int | None = None,
    attention: float | None = None,
    weights: Sequence[float] = WEIGHTS,
    by: str = "norm",
    group: int = GROUP,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids`` (unsigned 32-bit
    numbers, little endian), ``sequence_id`` and ``offset`` (place in the sequence, gapless from 0).

    A document is the ids of its whole text by the tokenizer file, then ``end_id``; one longer
    than ``tokens`` is cut, its first piece being the shorter one. A sequence holds at most
    ``tokens`` tokens, ``documents`` pieces (None: no bound) and an ``attention`` cost, the sum of
    squared lengths (None: no bound). A piece whose cost is beyond the bound by itself stands alone.

    Null and empty texts are one piece, the end id alone. Repeated rows, null or repeated ids are
    documents of their own. Pieces of equal length are placed in the order of their keys. Other
    columns are ignored. An empty table gives no rows.
    """
    pieces = stage(tokenize(docs, tokenizer, tokens, end_id, id_col, text_col), "packing-pieces")
    capacity = (tokens, documents or tokens, attention or float(tokens) ** 2)
    alone = F.col("length") == tokens
    short = pieces.filter(~alone).select("key", "length")
    groups = max(1, math.ceil(short.count() / group))
    places = stage(
        short.groupBy(F.pmod(F.xxhash64("key"), F.lit(groups)).alias("part"))
        .applyInArrow(lambda table: _pack_group(table, capacity, weights, by), "key long, sequence_id long, offset long"),
        "packing-places",
    )
    columns = ["doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids", "sequence_id", "offset"]
    whole = pieces.filter(alone).withColumns({"sequence_id": F.col("key"), "offset": F.lit(0).cast("long")})
    return whole.select(*columns).unionByName(pieces.filter(~alone).join(places, "key").select(*columns))


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id``, ``ids`` (binary), ``lengths`` of the pieces in order."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    return (
        packed.groupBy("sequence_id")
        .agg(parts.alias("parts"))
        .select(
            "sequence_id",
            F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
            F.transform("parts", lambda p: p["length"]).alias("lengths"),
        )
    )
