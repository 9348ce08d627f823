"""Chat formatting by incremental black-box rendering.

The template is a function from turns to text, of which nothing is known. Successive prefixes of
a conversation are rendered; where an output starts with the one before, the rest is the new
turn's span, and where it does not, the template has rewritten history. Prefixes are rendered
whole, whatever their length, so the work for a conversation grows with the square of its turns.
A caller who knows that a template adds a turn's text from the first and the last few turns alone
says so (``depends_on``); then each step renders only those, and the joined pieces have to equal
one rendering of the whole conversation, else its prefixes are rendered whole after all.

A conversation's rows are sorted within a partition and read as a stream, the turns of one
conversation in memory at a time: a template that may look at all of them needs them all.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]
#: The template's control strings.
USER, USER_END = "[INST]", "[/INST]"
REPLY, REPLY_END = "<s>", "</s>"
ROLE, ROLE_TEXT, ROLE_END = "[ROLE]", "[TEXT]", "[/ROLE]"
CONTROL = (USER, USER_END, REPLY, REPLY_END, ROLE, ROLE_TEXT, ROLE_END)
_GUARD = re.compile("|".join(map(re.escape, (*CONTROL, "\\"))))
_UNGUARD = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    """Control strings get a backslash after their first character, backslashes are doubled;
    the result holds no control string."""
    return _GUARD.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _UNGUARD.sub(r"\1", text)


def instruct_template(turns: list[Turn]) -> str:
    """User turns in [INST] marks, replies in <s> marks, any other role named in [ROLE] marks."""
    out = []
    for role, text in turns:
        if role == "user":
            out.append(f"{USER} {escape(text)} {USER_END}")
        elif role == "assistant":
            out.append(f"{REPLY}{escape(text)}{REPLY_END}")
        else:
            out.append(f"{ROLE}{escape(role)}{ROLE_TEXT}{escape(text)}{ROLE_END}")
    return "".join(out)


def reply_span(piece: str) -> tuple[int, int] | None:
    """Where a rendered turn is under the loss mask: a reply's text, without its marks."""
    if piece.startswith(REPLY) and piece.endswith(REPLY_END):
        return len(REPLY), len(piece) - len(REPLY_END)
    return None


class Incremental:
    """Pieces of one conversation, turn by turn: from whole prefixes, or from its first turn and the
    ``window`` turns before the new one."""

    def __init__(self, template: Template, window: int | None = None):
        self.template, self.window, self.known, self.last = template, window, [], ""
        self.length = 0

    def add(self, turn: Turn) -> tuple[str, int, bool]:
        """The new turn's piece, where it starts, and whether history was rewritten (then the
        piece is what follows the longest common beginning)."""
        old = self.last
        if self.window is not None and len(self.known) > self.window + 1:
            del self.known[1]
            old = self.template(self.known)
        self.known.append(turn)
        self.last = new = self.template(list(self.known))
        rewritten = not new.startswith(old)
        cut = len(old)
        if rewritten:
            cut = len(os.path.commonprefix([old, new]))
        piece, start = new[cut:], self.length - (len(old) - cut)
        self.length = start + len(piece)
        return piece, start, rewritten


def pieces(turns: list[Turn], template: Template, depends_on: int | None = None) -> list[tuple[str, int, bool]]:
    """``Incremental.add`` of every turn."""
    if depends_on is not None:
        cut = Incremental(template, depends_on)
        short = [cut.add(turn) for turn in turns]
        if not any(rewritten for _, _, rewritten in short) and template(turns) == "".join(piece for piece, _, _ in short):
            return short
    state = Incremental(template)
    return [state.add(turn) for turn in turns]


_PIECES = "conv_id long, n long, role string, piece string, start long, end long, mask_start long, mask_end long, rewritten boolean"


def _rows(conv, turns: list[tuple], template: Template, mask, depends_on) -> Iterator[pa.RecordBatch]:
    """The rows of one conversation, at most 1,000 in a batch."""
    names = ("conv_id", "n", "role", "piece", "start", "end", "mask_start", "mask_end", "rewritten")
    found = pieces([(role or "", text or "") for role, text in turns], template, depends_on)
    for at in range(0, len(turns), 1000):
        rows = []
        for n, (piece, start, rewritten) in enumerate(found[at : at + 1000], at):
            span = mask(piece)
            rows.append(
                (
                    conv, n + 1, turns[n][0], piece, start, start + len(piece),
                    start + span[0] if span else None, start + span[1] if span else None, rewritten,
                )
            )
        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=_schema())


def _format(batches: Iterator[pa.RecordBatch], template: Template, mask, depends_on) -> Iterator[pa.RecordBatch]:
    current, turns = None, []
    for batch in batches:
        for conv, role, text in zip(*[batch.column(k).to_pylist() for k in (0, 1, 2)], strict=True):
            if turns and conv != current:
                yield from _rows(current, turns, template, mask, depends_on)
                turns = []
            current = conv
            turns.append((role, text))
    if turns:
        yield from _rows(current, turns, template, mask, depends_on)


def _schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split(" ") for c in _PIECES.split(", "))])


def format_conversations(
    conversations: DataFrame, template: Template = instruct_template, mask=reply_span, depends_on: int | None = None
) -> DataFrame:
    """One row per turn in the order of ``turn`` (equal turns by role and text): ``conv_id``,
    ``n`` (place from 1), ``role``, ``piece`` (the turn as rendered; a conversation's formatted
    text is its pieces in order), ``start`` and ``end`` in that text, the span under the loss
    mask, and ``rewritten``: the template changed what it had rendered before. ``depends_on``
    states that a turn's text follows from the first turn, so many before it, and itself.

    Null roles and texts are empty, null turns come first, rows without ``conv_id`` are one
    conversation. Repeated rows are turns of their own. Other columns are ignored. No rows, no
    rows. Rows come sorted within partitions, a conversation in one of them.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
        F.col("turn").cast("long").alias("turn"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return ordered.mapInArrow(lambda b: _format(b, template, mask, depends_on), _PIECES)


def parse(piece: str) -> Turn:
    """A rendered turn, read back from its marks."""
    if piece.startswith(USER):
        return "user", unescape(piece[len(USER) + 1 : -len(USER_END) - 1])
    if piece.startswith(REPLY):
        return "assistant", unescape(piece[len(REPLY) : -len(REPLY_END)])
    role, text = piece[len(ROLE) : -len(ROLE_END)].split(ROLE_TEXT, 1)
    return unescape(role), unescape(text)


_READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewritten long"


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split(" ")[0] for c in _READ.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    done: list[tuple] = []
    open_ = None

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([d[i] for d in done], k) for i, k in enumerate(kinds)], names=names
        )

    def finish(s: dict) -> None:
        done.append((s["conv"], s["n"], s["turns"].hexdigest(), s["loss"], s["text"].hexdigest(), s["chars"], s["rewritten"]))

    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("conv_id", "n", "piece", "start", "mask_start", "mask_end", "rewritten")]
        for conv, n, piece, start, a, b, rewritten in zip(*columns, strict=True):
            if open_ is None or n == 1:
                if open_ is not None:
                    finish(open_)
                open_ = {"conv": conv, "n": 0, "turns": hashlib.sha256(), "loss": 0, "text": hashlib.sha256(), "chars": 0, "rewritten": 0}
            role, text = parse(piece)
            open_["n"] += 1
            open_["turns"].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            if a is not None:
                masked = unescape(piece[a - start : b - start])
                open_["loss"] += len(masked)
                open_["text"].update(masked.encode("utf-8", "surrogatepass"))
            open_["chars"] += len(piece)
            open_["rewritten"] += rewritten
        if done:
            yield flush()
            done = []
    if open_ is not None:
        finish(open_)
        yield flush()


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from the rendered pieces alone: turns, digests, characters under the
    mask, formatted characters, and turns at which history was rewritten. ``formatted`` as
    ``format_conversations`` returns it, in its order."""
    return formatted.mapInArrow(_read_back, _READ)
