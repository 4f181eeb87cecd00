r"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, and
of its text only the reply is trainable. A conversation that doesn't end with an assistant
turn has one more row, of kind ``context``, that carries its remaining turns and trains
nothing; so the output has every turn.

Template, turn by turn, nothing between:

    system      [SYS] text [/SYS]
    user        [INST] text [/INST]
    assistant   <s>text</s>
    any other   [ROLE percent-encoded-role] text [/ROLE]

Inside a text, each control string gets a backslash after its first character, besides any
that stand there (``</s>`` becomes ``<\/s>``, ``<\/s>`` becomes ``<\\/s>``); removing one
backslash from each gives the text back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.llm._common import schema, text_or_empty

EXAMPLES = "conv_id long, target_turn long, kind string, n_turns long, formatted string, loss_start long, loss_end long"
#: A batch of examples ends at so many characters.
BATCH_CHARS = 1 << 21

_CONTROL = r"/?(?:s>|INST\]|SYS\]|ROLE[ \]])"
_ESCAPE = re.compile(rf"([<\[])(\\*)({_CONTROL})")
_UNESCAPE = re.compile(rf"([<\[])\\(\\*)({_CONTROL})")
_TURN = re.compile(
    r"\[SYS\] (?P<system>.*?) \[/SYS\]|\[INST\] (?P<user>.*?) \[/INST\]|<s>(?P<assistant>.*?)</s>"
    r"|\[ROLE (?P<role>.*?)\] (?P<other>.*?) \[/ROLE\]",
    re.DOTALL,
)


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where in it the escaped text begins and ends."""
    body = escape(text)
    marks = {"system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": ("<s>", "</s>")}
    head, tail = marks.get(role) or (f"[ROLE {quote(role, safe='')}] ", " [/ROLE]")
    return head + body + tail, len(head), len(head) + len(body)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted example; ValueError if anything else is in it."""
    turns, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"text outside any turn at {at}")
        at = m.end()
        role = unquote(m["role"]) if m["role"] is not None else m.lastgroup
        turns.append((role, unescape(m["other"] if m["role"] is not None else m[m.lastgroup])))
    if at != len(formatted):
        raise ValueError(f"text outside any turn at {at}")
    return turns


def expand(turns: Iterable[tuple[int | None, int | None, str, str]]) -> Iterator[tuple]:
    """Rows of :data:`EXAMPLES` for (conv_id, turn, role, text) sorted by conversation and turn.

    Keeps the formatted prefix of one conversation; nothing else grows.
    """
    conv, prefix, n, tail = object(), "", 0, None
    for conv_id, turn, role, text in turns:
        if conv_id != conv:
            if tail is not None:
                yield (conv, tail, "context", n, prefix, len(prefix), len(prefix))
            conv, prefix, n = conv_id, "", 0
        piece, start, end = format_turn(role, text)
        at, n, tail = len(prefix), n + 1, turn if turn is not None else -1
        prefix += piece
        if role == "assistant":
            yield (conv, turn, "example", n, prefix, at + start, at + end)
            tail = None
    if tail is not None:
        yield (conv, tail, "context", n, prefix, len(prefix), len(prefix))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _batches(rows: Iterable[tuple], to: pa.Schema, chars) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += chars(row)
        if size >= BATCH_CHARS or len(held) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), to.types, strict=True)], schema=to)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), to.types, strict=True)], schema=to)


_EXAMPLES_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("target_turn", pa.int64()), ("kind", pa.string()), ("n_turns", pa.int64()),
     ("formatted", pa.string()), ("loss_start", pa.int64()), ("loss_end", pa.int64())]
)


def format_chat(conversations: DataFrame) -> DataFrame:
    """The examples of (conv_id, turn, role, text); other columns are not read.

    Rows of a conversation come together, in order of their turns. A null text or role is
    empty, null turns come first, equal turns go by role, then text; rows without a
    conv_id make up one conversation. Texts may be empty; an empty table gives no row.
    loss_start and loss_end are code points in ``formatted``.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        text_or_empty("role").alias("role"),
        text_or_empty("text").alias("text"),
    )
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(expand(_rows(batches)), _EXAMPLES_ARROW, lambda r: len(r[4]))

    return ordered.mapInArrow(run, schema(EXAMPLES))


DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
    "n_examples long"
)
_DIGEST_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
     ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_examples", pa.int64())]
)


def digest_examples(examples: Iterable[tuple]) -> Iterator[tuple]:
    """A row of :data:`DIGEST` for each conversation, read back from its examples alone."""

    def close():
        digest = hashlib.sha256()
        for role, text in read_turns(last):
            digest.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        return conv, n_turns, digest.hexdigest(), loss_chars, loss.hexdigest(), chars, n

    conv, last = object(), None
    for conv_id, _, kind, turns, formatted, start, end in examples:
        if conv_id != conv:
            if last is not None:
                yield close()
            conv, loss_chars, loss, chars, n = conv_id, 0, hashlib.sha256(), 0, 0
        last, n_turns = formatted, turns
        reply = unescape(formatted[start:end])
        loss_chars += len(reply)
        loss.update(reply.encode("utf-8", "surrogatepass"))
        chars += len(formatted)
        n += kind == "example"
    if last is not None:
        yield close()


def digests(examples: DataFrame) -> DataFrame:
    """Per conversation what its formatted examples say; see :func:`digest_examples`.

    Takes the rows as :func:`format_chat` leaves them: a conversation's together, in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(digest_examples(_rows(batches)), _DIGEST_ARROW, lambda _: 256)

    return examples.mapInArrow(run, schema(DIGEST))
