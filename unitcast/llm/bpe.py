"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For every prefix of a piece there is exactly one token that can end its
encoding.  ``PrefixTable`` stores that token per prefix, found left to right:
of the tokens that end at position i (an Aho-Corasick automaton lists them),
the valid one follows the last token of the prefix before it without a merge
across the seam.  The table makes appends
exact (old entries never change) and re-encodes an edit locally: entries
before the edit stay, and behind it the old entries are taken over as soon as
as many positions as the longest token agree.  An encoding is read off the
table from its end.

Texts are first split into pieces by the vocabulary's pattern; pieces are
encoded independently.  A piece that is itself in the vocabulary is that one
token.  ``encode`` / ``decode`` run it over a DataFrame; the vocabulary file is
read on the driver and broadcast (its size is that of the file, not of the
data).

Edge cases: a null text is encoded as empty text (no ids); repeated rows give
equal results; very long pieces cost time in proportion to their length; an
empty table gives an empty result; extra columns are kept (one named
like the result is replaced).
"""

from __future__ import annotations

import base64
import functools
import struct
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from unitcast.llm import common

CACHE_ENTRIES = 120_000     # entries that each of a worker's tables keeps at least
SHORT = 48                  # bytes of a piece whose table is filled from its end, where it is asked for
HEAD_BYTES = 10             # the entries of prefixes up to this length are shared by all pieces


# Ranges that the installed pattern library counts as letters or
# numbers and Unicode 16, the table of the byte-level encoders, does not assign.
UNASSIGNED = [
    (0x558, 0x558), (0x58b, 0x58c), (0x88f, 0x88f), (0xc5c, 0xc5c), (0xcdc, 0xcdc), (0x208f, 0x208f), (0x209d,
    0x209f), (0xa7ce, 0xa7cf), (0xa7d2, 0xa7d2), (0xa7d4, 0xa7d4), (0xa7dd, 0xa7dd), (0xa7e2, 0xa7e2), (0xa7f1,
    0xa7f1), (0xab6c, 0xab6d), (0x107bb, 0x107bf), (0x10940, 0x10959), (0x10ec5, 0x10ec7), (0x10ed9, 0x10eee),
    (0x11b0a, 0x11b0a), (0x11db0, 0x11ddb), (0x11de0, 0x11de9), (0x11df1, 0x11df1), (0x1246f, 0x1246f), (0x12475,
    0x1247f), (0x12550, 0x12686), (0x16ea0, 0x16eb8), (0x16ebb, 0x16ed3), (0x16ff2, 0x16ff6), (0x187f8, 0x187ff),
    (0x18cd6, 0x18cda), (0x18d09, 0x18d20), (0x18d80, 0x18df2), (0x18e00, 0x19191), (0x191a0, 0x191d2), (0x1b123,
    0x1b128), (0x1b168, 0x1b168), (0x1d6a6, 0x1d6a6), (0x1df1f, 0x1df24), (0x1df2b, 0x1df81), (0x1df90, 0x1df96),
    (0x1dfcd, 0x1dfff), (0x1e6c0, 0x1e6de), (0x1e6e0, 0x1e6e2), (0x1e6e4, 0x1e6e5), (0x1e6e7, 0x1e6ed), (0x1e6f0,
    0x1e6f4), (0x1e6fe, 0x1e6ff), (0x2b73a, 0x2b73f), (0x2b81e, 0x2b81e), (0x2cea2, 0x2cead), (0x323b0, 0x33479),
    (0x3d000, 0x3fc3f),
]
_UNASSIGNED = regex.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in UNASSIGNED) + "]")


class Vocabulary:
    """Ranks of a byte-level BPE and which tokens may follow each other."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.longest = max(map(len, ranks), default=1)
        self._halves: dict[int, tuple[int, int] | None] = {}
        self.follows = _Seams(self)
        self.heads: dict[bytes, int] = {}
        #: last three bytes -> length of the longest token that ends so
        self.reach: dict[bytes, int] = {}
        for token in ranks:
            end = token[-3:]
            self.reach[end] = max(len(token), self.reach.get(end, 0))

    @functools.cached_property
    def ending(self) -> ahocorasick.Automaton:
        """Finds the tokens that end at each byte, the bytes being signs U+0000 to U+00FF."""
        out = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            out.add_word(token.decode("latin-1"), (rank, len(token)))
        if self.ranks:
            out.make_automaton()
        return out

    @staticmethod
    def parse(data: bytes) -> Vocabulary:
        """From the lines ``base64(token) rank`` of a rank file."""
        pairs = (line.split() for line in data.splitlines() if line.strip())
        return Vocabulary({base64.b64decode(t): int(r) for t, r in pairs})

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``: (token, token) for a
        single byte, None if merging its bytes does not end in it."""
        if token in self._halves:
            return self._halves[token]
        parts = [bytes([b]) for b in self.tokens[token]]
        found: tuple[int, int] | None = (token, token) if len(parts) == 1 else None
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            if len(parts) == 2:
                found = (self.ranks[parts[0]], self.ranks[parts[1]])
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        self._halves[token] = found
        return found

    def seam(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both leaves the seam between them.
        Merges are undone from the latest to the earliest on both sides; the
        seam breaks if a pair across it ranks before the merge undone last."""
        if self.halves(right) is None:
            return False
        get, tokens = self.ranks.get, self.tokens
        bound = 1 << 60
        while True:
            if get(tokens[left] + tokens[right], 1 << 60) < bound:
                return False
            lone_left, lone_right = len(tokens[left]) == 1, len(tokens[right]) == 1
            if lone_left and lone_right:
                return True
            if not lone_left and (lone_right or left > right):
                bound, left = left, self.halves(left)[1]
            else:
                bound, right = right + 1, self.halves(right)[0]


    def extend(self, data: bytes, last: list[int], stop: int) -> None:
        """Append to ``last`` the tokens that end the prefixes of up to ``stop`` bytes."""
        follows, append, at = self.follows, last.append, len(last)
        begin = max(0, at + 1 - self.longest)       # no token of a new entry starts before it
        for end, (token, size) in self.ending.iter(data[begin:stop].decode("latin-1")) if self.ranks else ():
            end += begin
            if end != at:
                if end < at:
                    continue        # an old entry, or one that has its token
                break               # no valid token ends at ``at``
            start = end - size
            if self.halves(token) is not None if start < 0 else follows[last[start] << 32 | token]:
                append(token)
                at += 1
        if at < stop:
            raise ValueError("no valid token: the vocabulary lacks a byte")


    def encode(self, data: bytes) -> list[int]:
        """Tokens of a piece, read off its prefix table from the end.  Of a
        short piece only the entries that this asks for are filled."""
        if data in self.ranks:
            return [self.ranks[data]]
        if len(data) > SHORT:
            return PrefixTable(self, data).tokens()
        rank, follows, reach, heads, tokens = self.ranks.get, self.follows, self.reach.get, self.heads, self.tokens
        if len(heads) >= 2 * CACHE_ENTRIES:
            heads.clear()
        table: dict[int, int] = {}

        def last(end: int) -> int:
            if end <= HEAD_BYTES:
                head = data[:end]
                found = heads.get(head)
                if found is not None:
                    return found
            start = end - reach(data[end - 3:end] if end > 3 else data[:end], 2)
            if start <= 0:
                start, found = 1, rank(data[:end])
                if found is not None and self.halves(found) is None:
                    found = None
            else:
                found = None
            if found is None:
                for start in range(start, end):
                    found = rank(data[start:end])
                    if found is not None:
                        before = table.get(start)
                        if before is None:
                            before = last(start)
                        if follows[before << 32 | found]:
                            break
                else:
                    raise ValueError("no valid token: the vocabulary lacks a byte")
            table[end] = found
            if end <= HEAD_BYTES:
                heads[head] = found
            return found

        out, end = [], len(data)
        while end:
            token = table.get(end)
            if token is None:
                token = last(end)
            out.append(token)
            end -= len(tokens[token])
        return out[::-1]


class _Recent(common.Recent):
    def entries(self) -> int:
        return CACHE_ENTRIES


class _Seams(_Recent):
    """left << 32 | right -> ``Vocabulary.seam``."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def compute(self, pair: int) -> bool:
        return self.vocabulary.seam(pair >> 32, pair & 0xFFFFFFFF)


class PrefixTable:
    """``last[i]``: the token that ends the encoding of the first i + 1 bytes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def _extend(self, stop: int) -> None:
        """Compute the entries up to the prefix of ``stop`` bytes."""
        self.vocabulary.extend(self.data, self.last, stop)

    def append(self, more: bytes) -> None:
        """Append bytes; entries of earlier prefixes stay as they are."""
        self.data += more
        self._extend(len(self.data))

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Replace bytes ``start:stop``; returns how many entries were
        computed anew."""
        tail, data, computed, agree = self.last[stop:], self.data, 0, 0
        self.data = data[:start] + new + data[stop:]
        self.last = self.last[:start]
        changed = start + len(new)
        while len(self.last) < len(self.data):
            at = len(self.last) - changed
            if agree >= self.vocabulary.longest:
                self.last += tail[at:]
                break
            self._extend(len(self.last) + 1)
            computed += 1
            agree = agree + 1 if at >= 0 and tail[at] == self.last[-1] else 0
        return computed

    def tokens(self) -> list[int]:
        if self.data in self.vocabulary.ranks:
            return [self.vocabulary.ranks[self.data]]
        out, end = [], len(self.data)
        while end:
            out.append(self.last[end - 1])
            end -= len(self.vocabulary.tokens[out[-1]])
        return out[::-1]


_SIGNS = frozenset(".,;:!?)")      # a piece of their own behind letters


class _Irregular(Exception):
    pass


class _Chunks(_Recent):
    """Ids (little-endian bytes) of ``before + chunk``, computed when missing.
    A chunk that white space touches is irregular: its pieces depend on its
    neighbours."""

    def __init__(self, codec: Codec, before: str):
        super().__init__()
        self.codec, self.before = codec, before

    def compute(self, chunk: str) -> bytes:
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise _Irregular
        if chunk.isalpha():             # letters only: one piece
            return self.codec.encode_pieces([self.before + chunk])
        if chunk[-1] in _SIGNS and chunk[:-1].isalpha():
            return self[chunk[:-1]] + self.codec.encode_pieces(chunk[-1])
        return self.codec.encode_pieces(self.codec.pieces(self.before + chunk))


class Codec:
    """Text to ids and back.  No piece of the pattern crosses a blank that a
    letter, digit or sign follows, nor a line break between two such signs, so
    chunks between blanks are encoded once and remembered."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.pattern = vocabulary, regex.compile(pattern)
        self.first, self.later = _Chunks(self, ""), _Chunks(self, " ")
        self.newline = self.encode_pieces(["\n"])

    def pieces(self, text: str) -> list[str]:
        if text.isascii() or not _UNASSIGNED.search(text):
            return self.pattern.findall(text)
        plain = _UNASSIGNED.sub("\u00a4", text)
        return [text[m.start():m.end()] for m in self.pattern.finditer(plain)]

    def encode_pieces(self, pieces: Iterable[str]) -> bytes:
        ids: list[int] = []
        for piece in pieces:
            data = piece.encode("utf-8", "surrogatepass")
            rank = self.vocabulary.ranks.get(data)
            ids += [rank] if rank is not None else self.vocabulary.encode(data)
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        lines = []
        try:
            for line in text.split("\n"):
                chunks = line.split(" ")
                lines.append(self.first[chunks[0]] + b"".join(map(self.later.__getitem__, chunks[1:])))
        except _Irregular:
            return self.encode_pieces(self.pieces(text))
        return self.newline.join(lines)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@functools.lru_cache(maxsize=2)
def codec(data: bytes, pattern: str) -> Codec:
    return Codec(Vocabulary.parse(data), pattern)


def default_vocabulary() -> tuple[str, str]:
    """(path of the rank file, pattern)."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def _shared(df: DataFrame, path: str | None, pattern: str | None):
    given = default_vocabulary() if path is None or pattern is None else ("", "")
    with open(path or given[0], "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read()), pattern or given[1]


def _grown(df: DataFrame, name: str) -> StructType:
    return StructType([*df.schema.fields, StructField(name, BinaryType())])


def _with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, name])


def encode(df: DataFrame, text_col: str = "text", name: str = "ids", path: str | None = None,
           pattern: str | None = None) -> DataFrame:
    """Append ``name``: the ids of ``text_col`` as little-endian unsigned
    32-bit integers (binary)."""
    shared, pattern = _shared(df, path, pattern)
    plain = df.drop(name).withColumn(text_col, F.coalesce(F.col(text_col), F.lit("")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(shared.value, pattern)
        for batch in common.slices(batches):
            texts = batch.column(batch.schema.get_field_index(text_col))
            yield _with_column(batch, name, pa.array([coder.encode(t.as_py()) for t in texts], pa.binary()))

    return plain.mapInArrow(run, _grown(plain, name))


def decode(df: DataFrame, ids_col: str = "ids", name: str = "decoded", path: str | None = None,
           pattern: str | None = None) -> DataFrame:
    """Append ``name``: the bytes that the ids stand for (binary)."""
    shared, pattern = _shared(df, path, pattern)
    df = df.drop(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(shared.value, pattern)
        for batch in common.slices(batches):
            ids = batch.column(batch.schema.get_field_index(ids_col))
            yield _with_column(batch, name, pa.array([coder.decode(i.as_py() or b"") for i in ids], pa.binary()))

    return df.mapInArrow(run, _grown(df, name))


def round_trip(df: DataFrame, text_col: str = "text", ids: str = "ids", decoded: str = "decoded", path: str | None = None,
               pattern: str | None = None) -> DataFrame:
    """``encode`` and ``decode`` in one pass of one worker: the text column is
    replaced by ``ids`` and by ``decoded``, the bytes that these ids stand for."""
    shared, pattern = _shared(df, path, pattern)
    rest = [c for c in df.columns if c not in (text_col, ids, decoded)]
    plain = df.select(*rest, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    schema = StructType([*(df.schema[c] for c in rest), StructField(ids, BinaryType()), StructField(decoded, BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(shared.value, pattern)
        for batch in common.slices(batches):
            coded = [coder.encode(t.as_py()) for t in batch.column(len(rest))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(rest)], pa.array(coded, pa.binary()), pa.array([coder.decode(i) for i in coded], pa.binary())],
                names=[*rest, ids, decoded])

    return plain.mapInArrow(run, schema)
