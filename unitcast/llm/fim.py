"""Fill-in-middle transformation: cuts located in a wavelet matrix over
character classes.

Every byte of a text belongs to one class (continuation byte, first sign of a
word, later sign of a word, white space, line feed, other sign).  The classes
of a block of texts form one ``WaveletMatrix``; a rank query counts a class up
to any byte in three steps.  The number of units begun before a byte is a sum
of such ranks (``UNITS`` says of which classes), and the byte at which a given
unit begins is found by bisection on those sums, for all texts of a block at a
time.  Two cuts per text give prefix, middle and suffix, always at a unit's
border: code points, words or lines.

``transform`` draws the cuts and the form of each text from a digest of its
id, so a run repeats exactly and no row depends on another; ``restore`` reads
the text back from output and form.

Edge cases: a null text is empty; an empty text and one that holds a marker
stay as they are (form ``plain``); a null id counts as the empty string;
repeated rows give equal results; a very long text is a block of its own; an
empty table gives an empty result; extra columns are kept (one named like a
result is replaced).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from unitcast.llm import common

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
BLOCK_BYTES = 1 << 20       # bytes of text per wavelet matrix (more for a single longer text)
LEVELS = 3

CONTINUATION, WORD_START, WORD, SPACE, LINE, OTHER = range(6)

#: Classes whose signs begin a unit.  A line begins behind a line feed, so its count is one byte behind.
UNITS = {"code_point": (WORD_START, WORD, SPACE, LINE, OTHER), "word": (WORD_START,), "line": (LINE,)}


def _base_classes() -> np.ndarray:
    out = np.full(256, OTHER, dtype=np.uint8)
    out[0x80:0xC0] = CONTINUATION
    out[0xC0:] = WORD                                   # letters outside ASCII
    for b in b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz":
        out[b] = WORD
    for b in b" \t\r\x0b\x0c":
        out[b] = SPACE
    out[0x0A] = LINE
    return out


_BASE = _base_classes()


def byte_classes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Class of every byte of texts that begin at ``starts``."""
    out = _BASE[data]
    inside = (out == WORD) | (out == CONTINUATION)
    first = out == WORD
    first[1:] &= ~inside[:-1]
    begins = starts[starts < len(data)]
    first[begins] = out[begins] == WORD
    out[first] = WORD_START
    return out


class WaveletMatrix:
    """Rank over a sequence of small numbers: one bit vector per binary digit,
    the highest first, each stably partitioned by the digit before it."""

    def __init__(self, symbols: np.ndarray, levels: int = LEVELS):
        self.length, self.levels = len(symbols), levels
        self._bits, self._before, self._zeros = [], [], []
        now = symbols.astype(np.uint8)
        for level in range(levels - 1, -1, -1):
            ones = (now >> level & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            words = np.zeros(len(ones) // 64 + 1, dtype="<u8")
            words.view(np.uint8)[:len(packed)] = packed
            before = np.zeros(len(words), dtype=np.int64)
            np.cumsum(np.bitwise_count(words[:-1]), out=before[1:])
            self._bits.append(words)
            self._before.append(before)
            self._zeros.append(len(ones) - int(ones.sum()))
            now = np.concatenate([now[~ones], now[ones]])

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones before the positions ``at`` of a level."""
        word, rest = at >> 6, (at & 63).astype(np.uint64)
        low = self._bits[level][word] & ((np.uint64(1) << rest) - np.uint64(1))
        return self._before[level][word] + np.bitwise_count(low)

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before each of the positions ``at``."""
        low, high = np.zeros_like(at), at
        for i in range(self.levels):
            ones_low, ones_high = self._ones(i, low), self._ones(i, high)
            if symbol >> (self.levels - 1 - i) & 1:
                low, high = self._zeros[i] + ones_low, self._zeros[i] + ones_high
            else:
                low, high = low - ones_low, high - ones_high
        return high - low

    def count(self, classes: tuple[int, ...], at: np.ndarray) -> np.ndarray:
        """How many signs of ``classes`` occur before each of the positions."""
        return sum(self.rank(c, at) for c in classes)


class Cutter:
    """Unit counts and unit borders of a block of texts, given as one byte
    array and its ``n + 1`` offsets."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, unit: str = "code_point"):
        self.starts, self.ends = offsets[:-1], offsets[1:]
        self.classes = UNITS[unit]
        self.matrix = WaveletMatrix(byte_classes(data, self.starts))
        self.lines = unit == "line"
        self.before = self.matrix.count(self.classes, self.starts)
        counted = self.matrix.count(self.classes, self.ends) - self.before
        if self.lines:      # what follows the last line feed is a line too
            last = np.maximum(self.ends - 1, 0)
            open_end = (self.ends > self.starts) & (data[last] != 0x0A) if len(data) else np.zeros(len(self.ends), bool)
            counted = counted + open_end
        self.units = counted

    def cut(self, k: np.ndarray) -> np.ndarray:
        """Byte position (from the text's start) behind the first ``k`` units
        of each text: where unit k + 1 begins, or the end.  Bisection for the
        first position before which more than k units (for lines: k feeds)
        have begun."""
        low, high = self.starts.copy(), self.ends.copy()
        wanted = self.before + k + (0 if self.lines else 1)
        while True:
            open_ = low < high
            if not open_.any():
                break
            middle = (low + high) >> 1
            enough = self.matrix.count(self.classes, middle) >= wanted
            high = np.where(open_ & enough, middle, high)
            low = np.where(open_ & ~enough, middle + 1, low)
        # low: one behind the first byte of unit k + 1, or behind feed k, or the end
        if self.lines:
            return np.where(k == 0, 0, low - self.starts)
        reached = self.matrix.count(self.classes, low) >= wanted
        return np.where(reached, low - 1, self.ends) - self.starts


def draws(key: str, salt: str) -> tuple[int, int, int, int]:
    """Four numbers below 2^32 from the digest of ``salt:key``."""
    digest = hashlib.sha256(f"{salt}:{key}".encode()).digest()
    return tuple(int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12))


def _blocks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``BLOCK_BYTES`` of text each."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + BLOCK_BYTES, side="right")) - 1)
        yield a, min(b, n)
        a = b


def transform(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "code_point",
              salt: str = "1", plain_percent: int = 10, spm_percent: int = 20,
              markers: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> DataFrame:
    """Append ``n`` (units of the text), ``form`` (plain, psm, spm),
    ``prefix_units``, ``middle_units`` (null if plain) and ``output``.

    The prefix ends after the smaller of two draws modulo n + 1, the middle
    after the larger.  ``plain_percent`` of the texts stay as they are, and of
    all numbers below 100 those under ``spm_percent`` give suffix, prefix,
    middle; the others prefix, suffix, middle."""
    made = [StructField("n", LongType()), StructField("form", StringType()), StructField("prefix_units", LongType()),
            StructField("middle_units", LongType()), StructField("output", StringType())]
    names = [f.name for f in made]
    rest = [c for c in df.columns if c not in names]
    plain = df.select(*rest, F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_key"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("_whole"))
    p, s, m = (x.encode() for x in markers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            keys = batch.column(len(rest)).to_pylist()
            texts = batch.column(len(rest) + 1).cast(pa.large_binary())
            whole = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
            held = texts.buffers()[2]
            data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.empty(0, np.uint8)
            for a, b in _blocks(whole):
                part, offsets = data[whole[a]:whole[b]], whole[a:b + 1] - whole[a]
                cutter = Cutter(part, offsets, unit)
                drawn = np.array([draws(k, salt) for k in keys[a:b]], dtype=np.int64)
                one, two = (drawn[:, i] % (cutter.units + 1) for i in (0, 1))
                first, second = np.minimum(one, two), np.maximum(one, two)
                cuts = zip(cutter.cut(first).tolist(), cutter.cut(second).tolist(), offsets[:-1].tolist(),
                           offsets[1:].tolist(), drawn.tolist())
                forms, outputs = [], []
                content = part.tobytes()
                for x, y, start, end, d in cuts:
                    text = content[start:end]
                    if not text or p in text or s in text or m in text or d[2] % 100 >= 100 - plain_percent:
                        forms.append("plain")
                        outputs.append(text)
                    elif d[3] % 100 < spm_percent:
                        forms.append("spm")
                        outputs.append(b"".join((s, text[y:], p, text[:x], m, text[x:y])))
                    else:
                        forms.append("psm")
                        outputs.append(b"".join((p, text[:x], s, text[y:], m, text[x:y])))
                hidden = np.array([f == "plain" for f in forms])
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(a, b - a).columns[:len(rest)], pa.array(cutter.units, pa.int64()), pa.array(forms),
                     pa.array(first, pa.int64(), mask=hidden), pa.array(second - first, pa.int64(), mask=hidden),
                     pa.array(outputs, pa.binary()).cast(pa.string())], names=[*rest, *names])

    return plain.mapInArrow(run, StructType([*(df.schema[c] for c in rest), *made]))


def restored(output: Column, form: Column, markers: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text that ``transform`` turned into ``output``.  A text in the forms
    psm and spm holds no marker, so the first of each is the one written."""
    p, s, m = markers
    tail = F.length(output)

    def between(start: Column, stop: Column) -> Column:
        return F.substring(output, start, stop - start)

    in_s, in_p, in_m = (F.locate(x, output) for x in (s, p, m))
    middle = between(in_m + len(m), tail + 1)
    psm = F.concat(between(F.lit(1 + len(p)), in_s), middle, between(in_s + len(s), in_m))
    spm = F.concat(between(in_p + len(p), in_m), middle, between(F.lit(1 + len(s)), in_p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
