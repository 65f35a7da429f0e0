"""Document fingerprints by Order MinHash.

The items of a text are its k-mers of code points numbered by occurrence, so
a repeated k-mer counts as often as it occurs.  Each of ``SKETCHES`` hash
functions selects the ``PICK`` items with the smallest hashes; they are put
back into text order and the tuple is hashed to one number of the signature.
Two texts agree in a position if the same items are minimal *and* come in the
same order, which makes the likeness (share of equal positions) sensitive to
edit distance and not only to the set of k-mers.

``neighbour_edits`` also fingerprints, per document, an edited text (the last
third replaced by the start of the next document in descending id order) and
compares with the edited and the next document.  Texts are shuffled once into
id ranges; the first document of a range is copied into the range before it.

Edge cases: a null text is empty; an empty text has a fixed fingerprint; a
text with fewer than ``PICK`` items uses those it has, a text shorter than k
is one item; repeated ids are ordered by text; a single document is its own
next; a null id comes first in descending order; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from unitcast.llm import common

K = 8             # code points per k-mer; a power of two
PICK = 2          # items per sketch
SKETCHES = 64     # numbers per fingerprint

_U64 = np.uint64
_rng = np.random.default_rng(20240229)
_FACTORS = (_rng.integers(0, 1 << 31, SKETCHES, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)


def _mix(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit integers (xor-shift and multiply)."""
    x = (x ^ (x >> _U64(33))) * _U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U64(33))) * _U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U64(33))


def items(text: str, k: int = K) -> np.ndarray:
    """64-bit hashes of the occurrence-numbered k-mers in text order."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(_U64)
    if not len(codes):
        return codes
    if len(codes) < k:
        return _mix(np.array([hash_short(text)], dtype=_U64))
    h, span, base = codes + _U64(1), 1, 0x9E3779B97F4A7C15
    while span < k:     # double the length: hash of 2s points from two hashes of s
        h, span, base = h[:-span] + h[span:] * _U64(base), 2 * span, base * base % (1 << 64)
    h = _mix(h)
    ordered = np.sort(h)
    if (ordered[1:] == ordered[:-1]).any():
        order = np.argsort(h, kind="stable")
        ordered = h[order]
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        index = np.arange(len(h))
        count = np.empty(len(h), dtype=_U64)
        count[order] = index - np.maximum.accumulate(np.where(new, index, 0))
        again = np.flatnonzero(count)       # first occurrences keep the k-mer's own hash
        h[again] = _mix(h[again] + count[again] * _U64(0xD6E8FEB86659FD93))
    return h


def hash_short(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def signature(text: str, k: int = K, pick: int = PICK) -> np.ndarray:
    """The Order MinHash numbers (uint32) of a text."""
    h = items(text, k)
    n = len(h)
    if n <= pick:
        chosen = np.tile(np.arange(n), (SKETCHES, 1))
    else:
        chosen = np.empty((SKETCHES, pick), dtype=np.int64)
        low = (h >> _U64(32)).astype(np.uint32)
        bound = min(1 << 32, (8 * pick << 32) // n)
        step = max(1, (1 << 20) // n)
        for a in range(0, SKETCHES, step):
            b = min(SKETCHES, a + step)
            drawn = low[None, :] * _FACTORS[a:b, None]
            flat = drawn.ravel()
            hits = np.flatnonzero(flat < bound) if bound < 1 << 32 else np.arange(len(flat))
            row, at = np.divmod(hits, n)
            order = np.argsort((row.astype(_U64) << _U64(32)) | flat[hits], kind="stable")
            row, at = row[order], at[order]
            first = np.searchsorted(row, np.arange(b - a + 1))
            enough = np.diff(first) >= pick
            for i in np.flatnonzero(~enough):       # too few below the bound: take all
                chosen[a + i] = np.argsort(drawn[i], kind="stable")[:pick]
            good = np.flatnonzero(enough)
            chosen[a + good] = at[first[good][:, None] + np.arange(pick)]
        chosen.sort(axis=1)
    out = np.full(SKETCHES, n if n < pick else pick, dtype=_U64)
    for j in range(chosen.shape[1]):
        out = _mix(out * _U64(0x9E3779B97F4A7C15) + h[chosen[:, j]])
    return (_mix(out + np.arange(SKETCHES, dtype=_U64)) >> _U64(32)).astype(np.uint32)


def as_text(numbers: np.ndarray) -> str:
    return numbers.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal positions of two signatures."""
    return float(np.mean(a == b))


def edited(text: str, following: str) -> str:
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fingerprint)`` of every row, without a shuffle."""

    @F.pandas_udf("string")
    def mark(text: pd.Series) -> pd.Series:
        return text.map(lambda t: as_text(signature(t or "")))

    return docs.select(F.col(id_col).alias("doc_id"), mark(F.coalesce(F.col(text_col), F.lit(""))).alias("fingerprint"))


_RESULT = ("_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


def neighbour_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    ranges: int | None = None) -> DataFrame:
    spark = docs.sparkSession
    plain = common.texts(docs, id_col, text_col)
    cuts = common.id_cuts(plain.select("_id"), "_id", ranges or common.shuffle_partitions(spark))
    edges = np.array(cuts, dtype="int64")
    # largest id of each range: one row per range reaches the driver
    tops = {r["_range"]: r["_top"] for r in plain.select("_id", common.range_of("_id", cuts).alias("_range"))
            .groupBy("_range").agg(F.max("_id").alias("_top")).collect()}
    used = sorted(tops)
    copy_to = {tops[r]: used[(i + 1) % len(used)] for i, r in enumerate(used)}

    @F.pandas_udf("struct<own:int,copy:int>")
    def places(ids: pd.Series) -> pd.DataFrame:
        own = np.searchsorted(edges, ids.to_numpy(dtype="int64"), side="right").astype("int32")
        return pd.DataFrame({"own": own, "copy": ids.map(copy_to).astype("Int32")})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, None
        for batch in common.slices(batches):
            rows = []
            for place, copied, i, text in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if place != at:
                    at, held = place, None
                elif held is None:      # behind the last document's next one: further copies of that id
                    continue
                own = signature(text)
                if held is not None:
                    before, old, mark = held
                    new = edited(old, text)
                    other = signature(new)
                    rows.append((before, len(old), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(),
                                 as_text(mark), as_text(other), likeness(mark, other), likeness(mark, own)))
                held = None if copied else (i, text, own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate(
                    [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()])],
                names=["_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    spread = (plain.withColumn("_places", places("_id"))
              .withColumn("_place", F.explode(F.filter(F.array(
                  F.struct(F.col("_places.own").alias("range"), F.lit(False).alias("copied")),
                  F.struct(F.col("_places.copy").alias("range"), F.lit(True).alias("copied"))),
                  lambda p: p["range"].isNotNull()))))
    return (spread.select(F.col("_place.range").alias("_range"), F.col("_place.copied").alias("_copied"), "_id", "_text")
            .repartitionById(len(edges) + 1, F.col("_range"))
            .sortWithinPartitions("_range", "_copied", F.desc("_id"), "_text")
            .mapInArrow(run, _RESULT)
            .withColumn("doc_id", common.id_of("_id"))
            .select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"))
