"""Byte-level BPE over a corpus: every distinct word of a block travels once, is encoded once
among all blocks, and its ids come back to be laid out by position.

A task splits its documents into pre-tokens and keeps, for a block of documents, the list of
distinct pre-tokens and its documents as positions in that list. The positions are written to a
table bucketed by block and never move again. Only the distinct pre-tokens are shuffled, by a
hash of the word, so that all blocks' copies of a word meet and are encoded once; the ids return
to their blocks, meet the positions there and are laid out in order. Work and memory of a task
follow the block size and the number of parts, both of which are bounded, whatever word is
frequent. Decoding joins the ids with the token-byte table, which has as many rows as the
vocabulary (fixed, about 50,000) and is therefore sent to every task.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import math
import re
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.llm.common import bounded_batches, stage_bucketed

#: Characters of text after which a block is closed. A task holds a block's pieces, words and
#: positions, about 25 bytes for each of its characters.
BLOCK_CHARS = 2_000_000
#: Distinct words that one encoding group should hold.
GROUP_WORDS = 400_000
#: A space before white space or the end: only then can a token reach over a space.
_AWKWARD = re.compile(r" (?:\s|\Z)|[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file (base64, space, id on each line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class _Splitter:
    """Pre-tokens of a block's texts as positions in ``words``, its distinct pre-tokens.

    A single space between two other characters always starts a token, so texts are cut there
    and every distinct piece is matched against the pattern once. Texts with a space next to
    other white space are matched as a whole. Nothing refers back to it, so a block's words and
    pieces are freed with it, not when Python next looks for cycles.
    """

    def __init__(self, pattern: str):
        import regex

        self.find = regex.compile(pattern).findall
        self.words: dict[str, int] = {}
        self.pieces = _Pieces(self.words, self.find)

    def read(self, text: str) -> tuple[np.ndarray, np.ndarray | None]:
        """Positions of the text's beginning, numbers of the pieces after it."""
        if not text or _AWKWARD.search(text):
            return np.array(_positions(self.words, self.find(text)), np.int32), None
        head, *rest = text.split(" ")
        return np.array(_positions(self.words, self.find(head)), np.int32), np.fromiter(
            map(self.pieces.__getitem__, rest), np.int32, len(rest)
        )

    def positions(self, docs: list[tuple[np.ndarray, np.ndarray | None]]) -> Iterator[np.ndarray]:
        ends, flat = np.array(self.pieces.ends, np.int64), np.array(self.pieces.flat, np.int32)
        for head, index in docs:
            if index is None:
                yield head
            else:
                yield np.concatenate([head, flat[_ranges(ends[index], ends[index + 1] - ends[index])]])


def _positions(known: dict[str, int], words: list[str]) -> list[int]:
    return [known.setdefault(w, len(known)) for w in words]


class _Pieces(dict):
    """Number of a piece (text after a space); ``flat`` has the positions of all pieces in turn."""

    def __init__(self, words: dict[str, int], find):
        self.words, self.find, self.flat, self.ends = words, find, array("i"), array("q", [0])

    def __missing__(self, piece: str) -> int:
        self.flat.extend(_positions(self.words, self.find(" " + piece)))
        self.ends.append(len(self.flat))
        number = self[piece] = len(self.ends) - 2
        return number


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for every start, one after the other."""
    stops = np.cumsum(lengths)
    if len(stops) == 0 or stops[-1] == 0:
        return np.empty(0, np.int64)
    return np.arange(stops[-1]) + np.repeat(starts - (stops - lengths), lengths)


def _pack(numbers: np.ndarray) -> bytes:
    """Numbers from 0 as compressed bytes: one each below 255, else four more, plane by plane."""
    low = np.minimum(numbers, 255).astype(np.uint8)
    high = numbers[numbers >= 255].astype(np.uint32)
    return zstandard.compress(low.tobytes() + high.view(np.uint8).reshape(-1, 4).T.tobytes(), 3)


def _unpack(blob: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8)
    out = raw[:n].astype(np.int64)
    out[out == 255] = raw[n:].reshape(4, -1).T.copy().view(np.uint32).ravel()
    return out


def _pack_lists(lists: list[bytes]) -> bytes:
    """Byte strings as their packed lengths and their contents."""
    lengths = _pack(np.array([len(x) for x in lists], np.int64))
    return len(lengths).to_bytes(4, "little") + lengths + zstandard.compress(b"".join(lists), 6)


def _unpack_lists(blob: bytes, n: int) -> tuple[np.ndarray, bytes]:
    cut = 4 + int.from_bytes(blob[:4], "little")
    return _unpack(blob[4:cut], n), zstandard.decompress(blob[cut:])


def _blocks(batches: Iterator[pa.RecordBatch], pattern: str, parts: int) -> Iterator[pa.RecordBatch]:
    """For each block: a row with its documents (ids, packed numbers of pre-tokens), a row with the
    packed positions of all of them in turn, a row with how often each word stands there, and a row
    with the distinct words of each part, in order. Positions count the words most frequent first,
    so that most are small; the frequencies, which pack well, give that order back. A block closes
    when it holds ``BLOCK_CHARS`` characters or its partition ends, however the rows come in batches."""
    split, ids, read, size = _Splitter(pattern), [], [], 0
    for batch in batches:
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = text.as_py() or ""
            ids.append(i)
            read.append(split.read(text))
            size += len(text)
            if size >= BLOCK_CHARS:
                yield _block(split, ids, read, parts)
                split, ids, read, size = _Splitter(pattern), [], [], 0
    if ids:
        yield _block(split, ids, read, parts)


def _block(split: _Splitter, ids: list[int | None], read: list, parts: int) -> pa.RecordBatch:
    docs = list(split.positions(read))
    lengths, flat = np.array([len(d) for d in docs], np.int64), np.concatenate(docs)
    words = [w.encode() for w in split.words]
    part = [xxhash.xxh32_intdigest(w) % parts for w in words]
    order = sorted(range(len(words)), key=lambda i: (part[i], words[i]))
    times = np.bincount(flat, minlength=len(words))[order]
    position = np.empty(len(words), np.int64)
    position[np.array(order, np.int64)[_by_times(times)]] = np.arange(len(words))
    groups = [(p, [words[i] for i in g]) for p, g in itertools.groupby(order, key=part.__getitem__)]
    rows = [
        (_DOCS, len(docs), _pack(lengths), ids),
        (_PLACES, len(flat), _pack(position[flat]), None),
        (_TIMES, len(words), _pack(times), None),
        *[(p, len(g), _pack_lists(g), None) for p, g in groups],
    ]
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64())]
    columns = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
    block = pa.array([uuid.uuid4().int >> 65] * len(rows), pa.int64())
    return pa.RecordBatch.from_arrays([block, *columns], names=["block", "part", "n", "packed", "ids"])


_BLOCKS = "block long, part int, n int, packed binary, ids array<long>"
#: What stands in place of a part in the rows of a block that hold no words.
_DOCS, _PLACES, _TIMES = -1, -2, -3


def _by_times(times: np.ndarray) -> np.ndarray:
    """Words most frequent first."""
    return np.argsort(-times, kind="stable")


def _encode_part(table: pa.Table, pattern: str, ranks) -> pa.Table:
    """The words of one part, from all blocks: each distinct one is encoded once."""
    encoding = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks.value, special_tokens={})
    known: dict[bytes, bytes] = {}
    out = []
    for n, blob in zip(table.column("n").to_pylist(), table.column("packed"), strict=True):
        lengths, content = _unpack_lists(blob.as_py(), n)
        ids, at = [], 0
        for size in lengths.tolist():
            word = content[at : at + size]
            at += size
            got = known.get(word)
            if got is None:
                got = known[word] = np.array(encoding.encode_ordinary(word.decode()), np.int32).tobytes()
            ids.append(got)
        out.append(_pack_lists(ids))
    return pa.table(
        {"block": table.column("block"), "part": table.column("part"), "n": table.column("n"), "packed": pa.array(out, pa.binary())}
    )


def _lay_out(docs: pa.Table, words: pa.Table) -> pa.Table:
    """Ids of each document of a block, in the order of its positions."""
    words = words.sort_by("part")
    sizes, ids = [np.empty(0, np.int64)], []
    for n, blob in zip(words.column("n").to_pylist(), words.column("packed"), strict=True):
        lengths, content = _unpack_lists(blob.as_py(), n)
        sizes.append(lengths // 4)
        ids.append(content)
    ids, size = np.frombuffer(b"".join(ids), np.int32), np.concatenate(sizes)
    held = {part: i for i, part in enumerate(docs.column("part").to_pylist())}
    numbers = lambda part: _unpack(docs.column("packed")[held[part]].as_py(), docs.column("n")[held[part]].as_py())
    order, at = _by_times(numbers(_TIMES)), numbers(_PLACES)
    start, length = (np.cumsum(size) - size)[order][at], size[order][at]
    ends = np.cumsum(np.append(0, length))[np.cumsum(np.append(0, numbers(_DOCS)))]
    laid = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids[_ranges(start, length)]))
    return pa.table({"doc_id": pa.array(docs.column("ids")[held[_DOCS]].as_py(), pa.int64()), "ids": laid})


def _coded_blocks(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str, text_col: str):
    """Each block's rows cogrouped with the ids of its words, for ``_lay_out``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # About a distinct word for every 64 characters, which is more than natural text brings.
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(parallel, math.ceil(size / 64 / GROUP_WORDS))
    blocks = stage_bucketed(source.mapInArrow(lambda b: _blocks(b, pattern, parts), _BLOCKS), "bpe_blocks", "block")
    shared = spark.sparkContext.broadcast(ranks)

    coded = (
        blocks.filter("part >= 0")
        .select("block", "part", "n", "packed")
        .groupBy("part")
        .applyInArrow(lambda table: _encode_part(table, pattern, shared), "block long, part int, n int, packed binary")
    )
    return blocks.filter("part < 0").groupBy("block").cogroup(coded.groupBy("block"))


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``ids``: the token ids of each whole text, one row per row of ``docs``.

    Null and empty texts have no ids (an empty list). Repeated rows, repeated or null ids and
    other columns change nothing: rows are laid out by place, not by id. No rows, no rows.
    """
    return _coded_blocks(docs, ranks, pattern, id_col, text_col).applyInArrow(_lay_out, "doc_id long, ids array<int>")


def _decode(batches, shared, digest: bool, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    tokens = shared.value
    names = [str(i) for i in range(len(tokens))] if digest else []
    sha = lambda data: hashlib.sha256(data).hexdigest()
    for batch in batches:
        lists = batch.column(1)
        ends = np.asarray(lists.offsets)
        flat = np.asarray(lists.values)
        rows, numbers = [], []
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            ids = flat[a:b].tolist()
            decoded = b"".join(map(tokens.__getitem__, ids))
            rows.append(sha(decoded) if digest else decoded)
            if digest:
                numbers.append(sha(",".join(map(names.__getitem__, ids)).encode()))
        if digest:
            columns = [batch.column(0), pa.array(np.diff(ends).astype(np.int64)), pa.array(numbers, pa.string()), pa.array(rows, pa.string())]
            columns[2:2] = [lists] if keep_ids else []
            named = ["doc_id", "n_tokens", *(["ids"] if keep_ids else []), "ids_sha256", "decoded_sha256"]
            yield pa.RecordBatch.from_arrays(columns, names=named)
        else:
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(rows, pa.binary())], names=["doc_id", "ids", "decoded"])


def decode(encoded: DataFrame, ranks: dict[bytes, int], digest: bool = False, keep_ids: bool = False) -> DataFrame:
    """``encoded`` with ``decoded``: the bytes of ``ids``, by a join with the token-byte table.

    With ``digest``, instead: ``doc_id``, ``n_tokens``, hex digests of the ids (decimal, joined
    by commas) and of the decoded bytes, taken in the same pass; ``ids`` too with ``keep_ids``.
    """
    shared = _token_bytes(encoded.sparkSession, ranks)
    schema = _digests(keep_ids) if digest else "doc_id long, ids array<int>, decoded binary"
    return encoded.select("doc_id", "ids").mapInArrow(lambda b: _decode(b, shared, digest, keep_ids), schema)


def _token_bytes(spark: SparkSession, ranks: dict[bytes, int]):
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return spark.sparkContext.broadcast(table)


def _digests(keep_ids: bool) -> str:
    return f"doc_id long, n_tokens long, {'ids array<int>, ' if keep_ids else ''}ids_sha256 string, decoded_sha256 string"


def round_trip(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``decode(encode(docs), digest=True)``. A block's ids are decoded where they are laid
    out, so a task has one Python worker instead of two, and the ids do not pass between them."""
    shared = _token_bytes(docs.sparkSession, ranks)

    def laid_out(placed: pa.Table, words: pa.Table) -> pa.Table:
        return pa.Table.from_batches(_decode(_lay_out(placed, words).to_batches(), shared, True, keep_ids))

    return _coded_blocks(docs, ranks, pattern, id_col, text_col).applyInArrow(laid_out, _digests(keep_ids))
