"""Chat formatting with a grammar round trip.

The template opens and closes every turn with control strings.  A rendered
turn is reparsed by a deterministic parser and compared with its source; as
long as they differ, its content is escaped further:

* level 0: as it is;
* level 1: a backslash after the first sign of every control string, and one
  more where a bracket is already followed by backslashes;
* level 2: a backslash after every bracket.

Unescaping takes one backslash after each bracket, so every level reverses to
the source and clean texts stay as they are.  The loss mask is a list of
character spans that cover exactly the (escaped) assistant texts.

Conversations are sorted in one shuffle and rendered in a stream: output rows
are chunks of at most one conversation, closed at a turn border once they hold
``CHUNK_CHARS`` characters, so memory does not grow with a conversation.

Edge cases: a null role or text is empty; turns of equal number are ordered by
role and text, null turns come first; repeated rows are turns of their own; a
null conversation id is one conversation; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_CHARS = 1 << 20

#: role -> (opening, closing); another role is named in the text itself.
TEMPLATE = {"system": ("<<SYS>>\n", "\n<</SYS>>"), "user": ("[INST] ", " [/INST]"), "assistant": ("<s>", "</s>")}
OTHER = ("[ROLE]", "[/ROLE]", "[/TEXT]")
LOSS_ROLE = "assistant"

_CONTROLS = sorted({c.strip() for pair in TEMPLATE.values() for c in pair} | set(OTHER), key=lambda c: (-len(c), c))
_CONTROL = re.compile("|".join(map(re.escape, _CONTROLS)))
_ESCAPE = {1: re.compile(r"([<\[])(?=\\|" + "|".join(re.escape(c[1:]) for c in _CONTROLS) + ")"),
           2: re.compile(r"([<\[])")}
_ESCAPED = re.compile(r"([<\[])\\")


class GrammarError(ValueError):
    pass


def escape(text: str, level: int) -> str:
    return _ESCAPE[level].sub(r"\1\\", text) if level else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _render(role: str, text: str) -> tuple[str, int]:
    """Rendered turn and where its text begins."""
    if role in TEMPLATE:
        opening, closing = TEMPLATE[role]
    else:
        opening, closing = OTHER[0] + role + OTHER[1], OTHER[2]
    return opening + text + closing, len(opening)


def parse(text: str) -> list[tuple[str, str, int, int]]:
    """(role, text, begin, end) of each turn, still escaped; raises
    ``GrammarError`` unless the whole text is a list of turns."""
    turns, at = [], 0
    openings = {o.strip(): (role, o, c) for role, (o, c) in TEMPLATE.items()}

    def until(begin: int, control: str) -> int:
        found = _CONTROL.search(text, begin)
        if not found or found.group() != control:
            raise GrammarError(f"expected {control} after character {begin}")
        return found.start()

    while at < len(text):
        found = _CONTROL.match(text, at)
        if found and found.group() in openings:
            role, opening, closing = openings[found.group()]
            begin = at + len(opening)
            end = until(found.end(), closing.strip()) - (len(closing) - len(closing.lstrip()))
            if end < begin or not text.startswith(opening, at) or not text.startswith(closing, end):
                raise GrammarError(f"malformed turn at character {at}")
            at = end + len(closing)
        elif found and found.group() == OTHER[0]:
            stop = until(found.end(), OTHER[1])
            role, begin = text[found.end():stop], stop + len(OTHER[1])
            end = until(begin, OTHER[2])
            at = end + len(OTHER[2])
        else:
            raise GrammarError(f"no turn at character {at}")
        turns.append((role, text[begin:end], begin, end))
    return turns


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """(rendered turn, begin, end of its text), escaped until the parser
    recovers exactly this turn."""
    for level in (0, 1, 2):
        inner = escape(text, level)
        named = role if role in TEMPLATE else escape(role, level)
        out, begin = _render(named, inner)
        try:
            back = [(unescape(r), unescape(t)) for r, t, _, _ in parse(out)]
        except GrammarError:
            continue
        if back == [(role, text)]:
            return out, begin, begin + len(inner)
    raise GrammarError(f"turn of role {role!r} does not round-trip")


_CHUNKS = "conv_id long, chunk int, formatted string, loss_begin array<int>, loss_end array<int>"


def format_conversations(rows: DataFrame, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Chunks of formatted conversations with the loss spans inside each
    chunk, in (conv_id, chunk) order within partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, chunk, parts, size, begins, ends, started = None, 0, [], 0, [], [], False

        def closed():
            kinds = [pa.int64(), pa.int32(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip((conv, chunk, "".join(parts), begins, ends), kinds)],
                names=["conv_id", "chunk", "formatted", "loss_begin", "loss_end"])

        for batch in batches:
            for c, role, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if started and (c != conv or size >= chunk_chars):
                    yield closed()
                    chunk = chunk + 1 if c == conv else 0
                    parts, size, begins, ends = [], 0, [], []
                out, begin, end = render_turn(role, text)
                if role == LOSS_ROLE:
                    begins.append(size + begin)
                    ends.append(size + end)
                parts.append(out)
                size += len(out)
                conv, started = c, True
        if started:
            yield closed()

    plain = rows.select(F.col("conv_id").cast("long").alias("_conv"), F.coalesce(F.col("role"), F.lit("")).alias("_role"),
                        F.coalesce(F.col("text"), F.lit("")).alias("_text"), F.col("turn").alias("_turn"))
    return (plain.repartition("_conv").sortWithinPartitions("_conv", "_turn", "_role", "_text")
            .select("_conv", "_role", "_text").mapInArrow(run, _CHUNKS))


_DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long")


def read_back(chunks: DataFrame) -> DataFrame:
    """Parse formatted chunks (in the order ``format_conversations`` leaves
    them) and digest the recovered turns and the text under the loss mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None

        def row(s):
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            values = (s["conv"], s["turns"], s["all"].hexdigest(), s["loss_chars"], s["loss"].hexdigest(), s["chars"])
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)],
                                              names=[x.split()[0] for x in _DIGEST.split(", ")])

        for batch in batches:
            for conv, chunk, text, begins, ends in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if chunk == 0:
                    if state:
                        yield row(state)
                    state = {"conv": conv, "turns": 0, "all": hashlib.sha256(), "loss": hashlib.sha256(),
                             "loss_chars": 0, "chars": 0}
                for role, inner, _, _ in parse(text):
                    state["turns"] += 1
                    state["all"].update(f"{unescape(role)}\n{unescape(inner)}\n".encode("utf-8", "surrogatepass"))
                for begin, end in zip(begins, ends):
                    inner = unescape(text[begin:end])
                    state["loss_chars"] += len(inner)
                    state["loss"].update(inner.encode("utf-8", "surrogatepass"))
                state["chars"] += len(text)
        if state:
            yield row(state)

    return chunks.mapInArrow(run, _DIGEST)
