"""Spelling variants: words one edit apart, found through a variable-length
gram index.

1. Words of the texts are counted (runs of Latin letters, only A-Z
   lower-cased; ``thinned`` runs lose one code point, see ``word_counts``).
2. Gram dictionary: all grams of ``SHORTEST`` to ``LONGEST`` code points of the
   words between two end marks are counted.  A gram stays as it is if it is
   rare and is extended while it is frequent, so the dictionary is the set of
   frequent grams.  The bound of "frequent" grows with the number of gram
   positions, so that no more than ``DICTIONARY`` grams can pass it.
3. A word is decomposed at every position into the shortest gram that is not
   frequent (or is ``LONGEST`` long, or ends the word).  A gram depends on its
   own signs only, so an edit affects exactly the grams that cover its place.
   ``affected`` is the largest number of grams over one place: the word and
   any word one edit away share all but so many of its grams.
4. Merging lists: grams are ordered by frequency, the rarest first.  Two words
   that share ``|grams| - affected`` grams share at least ``SHARED`` of their
   first ``affected + SHARED`` ones.  (A word of n code points has n + 1 grams
   and at most ``LONGEST`` are affected, so at least ``SHARED`` remain from
   ``FEWEST`` code points on.)  The words are therefore listed under each pair
   of these few grams instead of under every gram.
5. Every list is read by one stream of a task, sorted by length, and words of
   at most one code point's difference in length are compared: letter sets drop
   most pairs, common prefix and suffix decide the rest exactly.  Only links
   leave the task, never the pairs of a list.
6. Links are reduced once by word: number of near words, form, and the root
   that the forms lead to (by pointer jumping).

Edge cases: a null text has no words; a null id counts as the empty string;
repeated rows count again; very long words are compared exactly like others;
ties of n go to the word smallest in code-point order; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from unitcast.llm import common

FEWEST = 6                  # code points of a word
LEAST = 5                   # occurrences of a word
THINNED = 199               # one run of a document in so many loses a code point
RATIO = 5                   # a form has at least so many times the occurrences
SHORTEST, LONGEST = 2, 5    # code points of a gram
SHARED = 2                  # grams that make a list
FREQUENT = 100              # words that hold a frequent gram, at least
DICTIONARY = 100_000        # bound of the frequent grams
HELD_WORDS = 200_000        # counted words that a task holds before it hands them on
WIDE = 40                   # code points up to which words are compared as rows of a matrix
ROWS = 60_000               # list entries compared at a time (more for a longer list)
START, END = "^", "$"

_RUN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\xbf])+")


def words_of(key: str, text: bytes) -> Counter:
    """Counts of the words (UTF-8) of one text, of any length.  A run whose
    digest with the document's key is divided by ``THINNED`` loses a code point."""
    runs = Counter(_RUN.findall(text.lower()))      # lower() of bytes: A-Z only
    out, head = Counter(), f"{key}:".encode()
    for run, n in runs.items():
        h = zlib.crc32(head + run)
        if h % THINNED == 0:
            signs = run.decode()
            at = h % len(signs)
            run = (signs[:at] + signs[at + 1:]).encode()
        out[run] += n
    return out


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, n)`` of all words of at least ``FEWEST`` code points and
    ``LEAST`` occurrences."""
    plain = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_key"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("_text"))

    def handed(held: Counter) -> pa.RecordBatch:
        return pa.record_batch([pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())],
                               names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in common.slices(batches):
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                for word, n in words_of(key, text.as_py()).items():
                    if len(word) >= FEWEST:
                        held[word] += n
                if len(held) >= HELD_WORDS:
                    yield handed(held)
                    held.clear()
        if held:
            yield handed(held)

    counted = plain.mapInArrow(run, "word string, n long").filter(F.length("word") >= FEWEST)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST)


def frequent_grams(words: DataFrame) -> dict[str, int]:
    """Grams held by many words, and by how many positions."""
    positions = words.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    # each length has at most ``positions`` grams in all, so fewer than DICTIONARY grams pass the bound
    bound = max(FREQUENT, -(-positions * (LONGEST - SHORTEST + 1) // DICTIONARY))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def handed() -> pa.RecordBatch:
            return pa.record_batch([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["gram", "n"])

        for batch in batches:
            for word in batch.column(0).to_pylist():
                signs = START + word + END
                for size in range(SHORTEST, LONGEST + 1):
                    held.update([signs[i:i + size] for i in range(len(signs) - size + 1)])
                if len(held) >= HELD_WORDS:
                    yield handed()
                    held.clear()
        if held:
            yield handed()

    grams = words.select("word").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return {r["gram"]: r["n"] for r in grams.filter(F.col("n") > bound).collect()}


def decompose(word: str, frequent: dict[str, int]) -> list[tuple[int, str]]:
    """(position, gram) at every position of the word between its end marks."""
    signs = START + word + END
    out, n = [], len(signs)
    for p in range(n - SHORTEST + 1):
        stop = p + SHORTEST
        while stop < n and stop - p < LONGEST and signs[p:stop] in frequent:
            stop += 1
        out.append((p, signs[p:stop]))
    return out


def affected(grams: list[tuple[int, str]]) -> int:
    """The most grams that cover one place: as many as one edit can change."""
    cover = Counter()
    for p, g in grams:
        cover.update(range(p, p + len(g)))
    return max(cover.values())


def listed(word: str, frequent: dict[str, int]) -> Iterator[str]:
    """Names of the lists that a word is on."""
    grams = decompose(word, frequent)
    seen: Counter = Counter()
    tokens = []
    for _, g in grams:      # a gram's second occurrence is another token
        tokens.append((frequent.get(g, 0), g, seen[g]))
        seen[g] += 1
    tokens.sort()
    names = [f"{g} {k}" for _, g, k in tokens[:affected(grams) + SHARED]]
    return map(" ".join, itertools.combinations(names, SHARED))


def _entries(words: DataFrame, frequent: dict[str, int]) -> DataFrame:
    """One row per word and list: 64-bit key, word, n."""
    shared = words.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value
        for batch in common.slices(batches, 4000):
            keys, sizes = [], []
            for word in batch.column(0).to_pylist():
                before = len(keys)
                keys += [hashlib.blake2b(name.encode(), digest_size=8).digest() for name in listed(word, frequent)]
                sizes.append(len(keys) - before)
            part = batch.take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b"".join(keys), "<i8")), *part.columns],
                                             names=["_key", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "_key long, word string, n long")


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one code point is inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


class _Words:
    """Words of a batch as a matrix of signs from the start and from the end."""

    def __init__(self, words: list[str]):
        self.words = words
        self.sizes = np.array([len(w) for w in words], dtype=np.int64)
        self.signs = np.zeros((len(words), WIDE), dtype=np.uint8)
        self.ends = np.zeros_like(self.signs)
        self.letters = np.zeros(len(words), dtype=np.uint64)
        for size in np.unique(self.sizes[self.sizes <= WIDE]):
            rows = np.flatnonzero(self.sizes == size)
            flat = np.frombuffer("".join([words[i] for i in rows]).encode("latin-1"), np.uint8).reshape(len(rows), size)
            self.signs[rows, :size] = flat
            self.ends[rows, :size] = flat[:, ::-1]
            for j in range(size):
                self.letters[rows] |= np.uint64(1) << (flat[:, j] & np.uint8(63)).astype(np.uint64)

    def near(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of the pairs (a[i], b[i]), of at most one sign's difference in
        length, that are one edit apart."""
        keep = np.bitwise_count(self.letters[a] ^ self.letters[b]) <= 2
        a, b = a[keep], b[keep]
        largest = np.maximum(self.sizes[a], self.sizes[b])
        wide = largest > WIDE
        found = np.zeros(len(a), dtype=bool)
        for i in np.flatnonzero(wide):
            found[i] = one_edit(self.words[a[i]], self.words[b[i]])
        rest = np.flatnonzero(~wide)
        for i in range(0, len(rest), 1 << 16):
            at = rest[i:i + (1 << 16)]
            x, y = a[at], b[at]
            head = (self.signs[x] == self.signs[y]).argmin(axis=1)      # 0 behind the word's end is equal too, the last column never is
            tail = (self.ends[x] == self.ends[y]).argmin(axis=1)
            same = (self.signs[x] == self.signs[y]).all(axis=1)
            head, tail = np.minimum(head, self.sizes[x]), np.minimum(tail, self.sizes[x])
            found[at] = ~same & (np.minimum(head, self.sizes[y]) + np.minimum(tail, self.sizes[y]) >= largest[at] - 1)
        return a[found], b[found]


def _pairs(keys: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one list whose sizes differ by one at most, some at a time."""
    order = np.lexsort((sizes, keys))
    k, n = keys[order], sizes[order]
    left, step = np.arange(len(k)), 1
    while True:
        left = left[left + step < len(k)]
        left = left[(k[left] == k[left + step]) & (n[left + step] - n[left] <= 1)]
        if not len(left):
            return
        yield order[left], order[left + step]
        step += 1


def _links(entries: DataFrame) -> DataFrame:
    """``(word, near, near_n)`` in both directions, once per block of lists."""

    def compare(keys: np.ndarray, table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        word, n = table.column("word").chunk(0), table.column("n").chunk(0)
        words = _Words(word.to_pylist())
        found = [words.near(a, b) for a, b in _pairs(keys, words.sizes)]
        if not sum(len(a) for a, _ in found):
            return
        codes = word.dictionary_encode().indices.to_numpy().astype(np.int64)
        a, b = np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])
        low, high = np.minimum(codes[a], codes[b]), np.maximum(codes[a], codes[b])
        _, once = np.unique(low * len(codes) + high, return_index=True)
        one, two = pa.array(np.concatenate([a[once], b[once]])), pa.array(np.concatenate([b[once], a[once]]))
        yield pa.RecordBatch.from_arrays([word.take(one), word.take(two), n.take(two)], names=["word", "near", "near_n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows, wanted = 0, ROWS
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < wanted:
                continue
            table = pa.Table.from_batches(held)
            keys = table.column(0).to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))      # the last list may go on
            if cut:
                yield from compare(keys[:cut], table.slice(0, cut))
            held, rows = table.slice(cut).to_batches(), len(keys) - cut
            wanted = max(ROWS, 2 * rows)
        if rows:
            table = pa.Table.from_batches(held)
            yield from compare(table.column(0).to_numpy(), table)

    return entries.repartition("_key").sortWithinPartitions("_key").mapInArrow(run, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` from ``(word, form)``, forms not null: the last word
    that the forms lead to.  Every round doubles the steps taken; counts grow
    by ``RATIO`` with each form, so a few rounds do.  A word that has no form of
    its own ends a path."""
    now = common.stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        stepped = now.join(ahead, F.col("root") == F.col("_at"), "left")
        if stepped.filter("_next IS NOT NULL").isEmpty():
            return now
        now = common.stored(stepped.select("word", F.coalesce("_next", "root").alias("root")), "roots")


def spelling_groups(words: DataFrame) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for a stored table ``(word, n)``
    of distinct words of at least ``FEWEST`` Latin-1 letters."""
    links = _links(_entries(words, frequent_grams(words)))
    # one exchange by word serves both aggregates
    near = (links.repartition("word").groupBy("word", "near").agg(F.max("near_n").alias("near_n"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                 F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w"))).alias("_best")))
    best = F.when(-F.col("_best.m") >= RATIO * F.col("n"), F.col("_best"))
    formed = common.stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), best["w"].alias("form"),
        (-best["m"]).alias("form_n")), "forms")
    found = roots(formed.filter("form IS NOT NULL"))
    return formed.join(found, "word", "left").select("word", "n", "n_near", "form", "form_n",
                                                     F.coalesce("root", "word").alias("root"))
