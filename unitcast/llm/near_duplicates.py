"""N-gram Jaccard join with Bayesian candidate pruning.

Links all pairs of different texts whose sets of five-word shingles have a
Jaccard similarity of at least ``threshold``, without ever writing the pairs.
A group of n similar texts is cut into at most ``SPLIT`` blocks (one of over
``SPLIT * LARGEST`` texts into n / ``LARGEST``), and a text costs one row for each
block that its buckets reach, in its own group or another; pairs exist as array
elements within a task only.

1. Equal texts are one node (128-bit digest); only one row of its smallest
   document goes on.
2. Candidates share all ``ROWS`` MinHash values of one of ``BANDS`` bands (a
   bucket).  A pair at the threshold 0.8 is missed with probability
   (1 - 0.8^8)^72, about 2e-6, and more similar pairs far less.
3. Nodes are dealt into blocks: around the smallest node that shares a bucket
   with them, groups of over ``BLOCK`` split by hash into blocks that grow with
   the group.  Every pair of blocks that shares a bucket is one task group; it
   gets those nodes of both blocks that share a bucket with a node of the other
   one and looks for candidates (equal bands) between them.  Each pair of nodes
   belongs to exactly one pair of blocks.
4. Pruning: ``CHECKS`` further MinHash values, independent of the bands, are
   compared ``STEP`` at a time.  After n values with m matches the similarity
   has a Beta(m + 1, n - m + 1) posterior (uniform prior); the pair is dropped
   once the probability of reaching the threshold falls below ``TOLERANCE``.
5. Jaccard distance is a metric: with the exact distances of all nodes of a
   task group to a few pivots, a pair whose distances to one pivot sum to at
   most 1 - threshold is a link, and one whose distances differ by more is
   none.  The pairs in between are verified exactly on the sets of 64-bit
   shingle hashes.  A group returns the number of links of each node and a
   spanning forest of them.

Candidate ids and copies are broadcast only if their counted rows are few;
otherwise the same join shuffles.  Classes are the connected components over
all links (equal texts included).

Edge cases: a null text is empty; a text without words is linked to nothing
and shares a class with equal texts only; a text of fewer than five words has
one shingle, all its words; null ids are one id after all others; repeated
rows of one id and text are one document; rows of one id with different texts
are in one class; an empty table gives an empty result; extra columns are
ignored (``one_per_class`` keeps them).
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from unitcast.llm import common
from unitcast.llm.components import components
from unitcast.llm.decontaminate import checked, shingle_hashes, words

WORDS = 5
MAX_BROADCAST_ROWS = 1_000_000   # of 16-byte nodes
THRESHOLD = 0.8
BANDS, ROWS = 72, 8
CHECKS, STEP = 128, 16
TOLERANCE = 1e-8
BLOCK, SPLIT, LARGEST = 128, 16, 1024     # nodes of a block of a small group; blocks of a larger one; nodes of a block at most
PIVOTS = 4
PAIRS = 1 << 18             # candidate pairs that a task holds at a time
SEGMENT = 1 << 16           # shingles hashed at a time

_rng = np.random.default_rng(20110429)
_FACTORS = (_rng.integers(0, 1 << 31, BANDS * ROWS + CHECKS, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def min_hashes(flat: np.ndarray, lengths: np.ndarray, which: slice) -> np.ndarray:
    """MinHash values (uint32) of consecutive non-empty sets, given as one flat
    array of 64-bit hashes: one row per set, one column per hash function."""
    factors = _FACTORS[which]
    out = np.empty((len(lengths), len(factors)), dtype=np.uint32)
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    a = 0
    while a < len(lengths):
        b = max(a + 1, int(np.searchsorted(starts, starts[a] + SEGMENT, side="right")) - 1)
        x = (_mix(flat[starts[a]:starts[b]].view(np.uint64)) >> np.uint64(32)).astype(np.uint32)
        at, drawn = starts[a:b] - starts[a], np.empty_like(x)
        for i in range(len(factors)):
            np.multiply(x, factors[i], out=drawn)
            out[a:b, i] = np.minimum.reduceat(drawn, at)
        a = b
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of each row of MinHash values."""
    grouped = values.reshape(len(values), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), grouped.shape[:2]).copy()
    for j in range(ROWS):
        key = _mix(key * _GOLD + grouped[:, :, j])
    return key


@functools.lru_cache(maxsize=None)
def fewest_matches(n: int, threshold: float, tolerance: float) -> int:
    """Smallest m of n for which P(similarity >= threshold | m of n) is at
    least ``tolerance``: with a uniform prior that probability is
    P(Binomial(n + 1, threshold) <= m)."""
    total = 0.0
    for m in range(n + 1):
        total += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        if total >= tolerance:
            return m
    return n


def likely(a: np.ndarray, b: np.ndarray, marks: np.ndarray, threshold: float, tolerance: float) -> np.ndarray:
    """Indexes of the pairs (a[i], b[i]) that the incremental comparison of
    their check values leaves."""
    alive, matches = np.arange(len(a)), np.zeros(len(a), dtype=np.int64)
    for at in range(0, marks.shape[1], STEP):
        end = at + STEP
        matches = matches + (marks[a[alive], at:end] == marks[b[alive], at:end]).sum(axis=1)
        left = matches >= fewest_matches(end, threshold, tolerance)
        alive, matches = alive[left], matches[left]
    return alive


class Sets:
    """Exact similarities of many sets: their members are numbered once, a set
    is marked in a table of all members, and the marks under the members of
    other sets are summed."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        members, self.codes = np.unique(np.concatenate(sets), return_inverse=True)
        self.marked = np.zeros(len(members), dtype=np.int32)

    def common(self, x: int, others: np.ndarray) -> np.ndarray:
        """Members that set ``x`` shares with each of ``others``."""
        own = self.codes[self.starts[x]:self.starts[x + 1]]
        self.marked[own] = 1
        sizes, shared, a = self.sizes[others], np.empty(len(others), dtype=np.int64), 0
        ends = np.cumsum(sizes)
        while a < len(others):      # SEGMENT members at a time
            before = ends[a] - sizes[a]
            b = max(a + 1, int(np.searchsorted(ends, before + SEGMENT, side="right")))
            begins = ends[a:b] - sizes[a:b] - before
            at = np.arange(ends[b - 1] - before) + np.repeat(self.starts[others[a:b]] - begins, sizes[a:b])
            shared[a:b] = np.add.reduceat(self.marked[self.codes[at]], begins)
            a = b
        self.marked[own] = 0
        return shared

    def distances(self, x: int) -> np.ndarray:
        """Jaccard distances of set ``x`` to all."""
        both = self.common(x, np.arange(len(self.sizes)))
        return 1 - both / (self.sizes[x] + self.sizes - both)

    def similar(self, x: int, others: np.ndarray, threshold: float) -> np.ndarray:
        """Which of ``others`` reach the threshold with set ``x``."""
        both = self.common(x, others)
        return both >= threshold * (self.sizes[x] + self.sizes[others] - both) - 1e-9


def pivot_distances(sets: Sets) -> np.ndarray:
    """Distances of all sets to ``PIVOTS`` of them: the first, then each time
    the set farthest from the pivots so far."""
    rows = [sets.distances(0)]
    while len(rows) < min(PIVOTS, len(sets.sizes)):
        rows.append(sets.distances(int(np.min(rows, axis=0).argmax())))
    return np.array(rows)


class Links:
    """Link counts of 0 .. n - 1 and the smallest node of each one's component."""

    def __init__(self, n: int):
        self.counts, self.roots = np.zeros(n, dtype=np.int64), np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.counts += np.bincount(a, minlength=len(self.counts)) + np.bincount(b, minlength=len(self.counts))
        while True:
            x, y = self.roots[a], self.roots[b]
            apart = x != y
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            np.minimum.at(self.roots, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
            while True:     # every root points to itself again
                up = self.roots[self.roots]
                if (up == self.roots).all():
                    break
                self.roots = up


def link_all(left: np.ndarray, right: np.ndarray, same: bool, keys: np.ndarray, marks: np.ndarray, sets: Sets,
             threshold: float, tolerance: float) -> Links:
    """Links between the nodes ``left`` and ``right`` (or within ``left``) of a task group."""
    out, to_pivots = Links(len(sets.sizes)), pivot_distances(sets)
    reach = 1 - threshold

    def settle(a: np.ndarray, b: np.ndarray) -> None:
        kept = likely(a, b, marks, threshold, tolerance)
        a, b = a[kept], b[kept]
        near, far = np.zeros(len(a), dtype=bool), np.zeros(len(a), dtype=bool)
        for d in to_pivots:
            near |= d[a] + d[b] <= reach - 1e-9
            far |= np.abs(d[a] - d[b]) > reach + 1e-9
        open_ = np.flatnonzero(~near & ~far)
        for x, at in zip(*_runs(a[open_])):     # pairs come ordered by a
            near[open_[at]] = sets.similar(x, b[open_[at]], threshold)
        out.add(a[near], b[near])

    held_a, held_b, held = [], [], 0
    for x in left:      # candidates: at least one equal band
        y = right[right > x] if same else right
        y = y[(keys[y] == keys[x]).any(axis=1)]
        held_a.append(np.full(len(y), x))
        held_b.append(y)
        held += len(y)
        if held >= PAIRS:
            settle(np.concatenate(held_a), np.concatenate(held_b))
            held_a, held_b, held = [], [], 0
    if held:
        settle(np.concatenate(held_a), np.concatenate(held_b))
    return out


def _runs(values: np.ndarray) -> tuple[list[int], list[slice]]:
    """Values of runs of equal values, and where the runs lie."""
    at = np.flatnonzero(np.diff(values, prepend=-1)) if len(values) else np.empty(0, np.int64)
    return values[at].tolist(), [slice(i, j) for i, j in zip(at.tolist(), [*at[1:].tolist(), len(values)])]


def _shingles(w: Column) -> Column:
    out = shingle_hashes(w, WORDS)
    for k in range(1, WORDS):
        out = F.when(F.size(w) == k, F.array(F.xxhash64(F.lit(k), F.concat_ws(" ", w)))).otherwise(out)
    return out


def _sets(nodes: DataFrame) -> DataFrame:
    """``(_node, _set)``: shingle hashes, empty for a text without words."""
    w = nodes.select("_node", words(F.col("_text")).alias("_w"))
    return w.select("_node", _shingles(F.col("_w")).alias("_set"))


def _flat(sets: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    return (sets.flatten().to_numpy(zero_copy_only=False),
            pc.list_value_length(sets).to_numpy(zero_copy_only=False))


def _band_rows(sets: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            batch = batch.filter(pc.greater(pc.list_value_length(batch.column(1)), 0))
            if not batch.num_rows:
                continue
            flat, lengths = _flat(batch.column(1))
            keys = band_keys(min_hashes(flat, lengths, slice(0, BANDS * ROWS)))
            nodes = batch.column(0).take(pa.array(np.repeat(np.arange(len(lengths)), BANDS)))
            yield pa.record_batch([nodes, pa.array(keys.reshape(-1).view(np.int64))], names=["_node", "_key"])

    return sets.mapInArrow(run, "_node binary, _key long")


def _marked(sets: DataFrame) -> DataFrame:
    """``(_node, _keys, _marks, _set)``: band keys, 16 bits of each check
    value, sorted shingle hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            batch = batch.filter(pc.greater(pc.list_value_length(batch.column(1)), 0))
            if not batch.num_rows:
                continue
            flat, lengths = _flat(batch.column(1))
            values = min_hashes(flat, lengths, slice(None))
            keys, marks = band_keys(values[:, :BANDS * ROWS]), values[:, BANDS * ROWS:].astype("<u2")
            parts = np.split(flat, np.cumsum(lengths)[:-1])
            yield pa.record_batch(
                [batch.column(0), pa.array([k.tobytes() for k in keys], pa.binary()),
                 pa.array([m.tobytes() for m in marks], pa.binary()),
                 pa.array([np.sort(p).astype("<i8").tobytes() for p in parts], pa.binary())],
                names=["_node", "_keys", "_marks", "_set"])

    return sets.mapInArrow(run, "_node binary, _keys binary, _marks binary, _set binary")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return common.texts(docs, id_col, text_col).withColumn("_node", F.unhex(F.md5(F.col("_text").cast("binary"))))


def _blocks(buckets: DataFrame) -> DataFrame:
    """``(_node, _block)`` from the rows ``(_node, _key, _least)`` of shared
    buckets: nodes around the smallest node they share a bucket with."""
    centres = common.stored(buckets.groupBy("_node").agg(F.min("_least").alias("_centre")), "centres")
    n = F.count(F.lit(1))
    blocks = F.least(F.ceil(n / BLOCK), F.greatest(F.lit(SPLIT), F.ceil(n / LARGEST)))
    sizes = centres.groupBy("_centre").agg(blocks.alias("_blocks"))
    return centres.join(sizes, "_centre").select(
        "_node", F.xxhash64("_centre", F.pmod(F.xxhash64("_node"), "_blocks")).alias("_block"))


def block_pairs(held: DataFrame) -> DataFrame:
    """``(_lo, _hi)``: pairs of blocks that share a bucket, from the different
    rows ``(_key, _block)``.  Similar texts share many buckets, so the buckets
    of a group hold few different sets of blocks; each set is paired once."""
    sets = held.groupBy("_key").agg(F.array_sort(F.collect_list("_block")).alias("_blocks"))
    sets = common.stored(sets.select("_blocks").distinct(), "block-sets")
    pairs = sets.select(F.explode("_blocks").alias("_lo"), "_blocks")
    return pairs.select("_lo", F.explode(F.filter("_blocks", lambda b: b >= F.col("_lo"))).alias("_hi")).distinct()


def dealt(buckets: DataFrame, blocks: DataFrame) -> DataFrame:
    """``(_node, _block, _lo, _hi)``: the pairs of blocks (``block_pairs``) that a
    node has candidates in.  It goes to the pair of its own and another block only
    if one of its own buckets holds a node of that block, and to its block's pair
    with itself only if a bucket holds another node of its block."""
    held = buckets.select("_node", "_key").join(blocks, "_node")
    counts = held.groupBy("_key", "_block").agg(F.count(F.lit(1)).alias("_c"))
    sets = counts.groupBy("_key").agg(F.array_sort(F.collect_list("_block")).alias("_blocks"),
                                      F.collect_list(F.when(F.col("_c") > 1, F.col("_block"))).alias("_several"))
    met = F.filter("_blocks", lambda b: (b != F.col("_block")) | F.array_contains("_several", b))
    of_node = (held.join(sets, "_key").select("_node", "_block", met.alias("_met")).filter(F.size("_met") > 0)
               .groupBy("_node", "_block").agg(F.array_distinct(F.flatten(F.collect_set("_met"))).alias("_met")))
    return of_node.select("_node", "_block", F.explode("_met").alias("_other")).select(
        "_node", "_block", F.least("_block", "_other").alias("_lo"), F.greatest("_block", "_other").alias("_hi"))


def _linked(bands: DataFrame, first: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """``(_a, _b, _n)``: link counts of nodes (``_b`` null; to be summed) and
    edges ``(_a, _b)`` of spanning forests (``_n`` 0).  ``bands`` has the band
    rows, ``first`` one row per node."""
    shared = bands.groupBy("_key").agg(F.min("_node").alias("_least"), F.count(F.lit(1)).alias("_c")).filter("_c > 1")
    buckets = common.stored(bands.join(shared.select("_key", "_least"), "_key"), "buckets")
    blocks = common.stored(_blocks(buckets), "blocks")
    wanted = dealt(buckets, blocks)
    near = first.join(checked(blocks.select("_node")), "_node", "left_semi")
    rows = _marked(_sets(near)).join(wanted, "_node")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("_node").sort_values("_node", ignore_index=True)
        lo, hi = group["_lo"].iloc[0], group["_hi"].iloc[0]
        nodes, n = group["_node"].to_numpy(), len(group)
        left = np.flatnonzero(group["_block"] == lo)
        right = np.flatnonzero(group["_block"] == hi)
        keys = np.array([np.frombuffer(k, "<u8") for k in group["_keys"]])
        marks = np.array([np.frombuffer(m, "<u2") for m in group["_marks"]])
        sets = Sets([np.frombuffer(s, "<i8") for s in group["_set"]])
        found = link_all(left, right, lo == hi, keys, marks, sets, threshold, tolerance)
        some, joined = np.flatnonzero(found.counts), np.flatnonzero(found.roots != np.arange(n))
        return pd.DataFrame({"_a": [*nodes[some], *nodes[joined]],
                             "_b": [*[None] * len(some), *nodes[found.roots[joined]]],
                             "_n": [*found.counts[some].tolist(), *[0] * len(joined)]})

    return rows.groupBy("_lo", "_hi").applyInPandas(compare, "_a binary, _b binary, _n long")


def _one_each(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """One of the rows of each node; ``repeated`` has the nodes of several."""
    n = repeated.count()
    if not n:
        return rows
    if n > MAX_BROADCAST_ROWS:
        return rows.dropDuplicates(["_node"])
    # the texts of the other nodes are not shuffled; each task hands on one row of a repeated node
    repeated = F.broadcast(repeated)
    return rows.join(repeated, "_node", "left_anti").unionByName(
        rows.join(repeated, "_node", "left_semi").dropDuplicates(["_node"]))


def join_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
               tolerance: float = TOLERANCE) -> tuple[DataFrame, DataFrame]:
    """``(nodes, links)``: nodes ``(_node, _first, _rows)`` are the different
    texts with their smallest document and row count; links as ``_linked``."""
    keyed = _keyed(docs, id_col, text_col)
    held = common.stored(keyed.groupBy("_node", "_id").agg(F.count(F.lit(1)).alias("_n")), "node-rows")
    nodes = common.stored(held.groupBy("_node").agg(F.min("_id").alias("_first"), F.sum("_n").alias("_rows")), "nodes")
    several = held.join(nodes.filter("_rows > 1").select("_node", "_first"), "_node")
    copies = several.filter("_id != _first").select("_node", "_id")
    first = keyed.join(checked(common.stored(copies, "copies")), ["_node", "_id"], "left_anti")
    repeated = several.filter("_id = _first AND _n > 1").select("_node")
    first = _one_each(first, common.stored(repeated, "repeated"))
    bands = common.stored(_band_rows(_sets(first)), "bands")
    return nodes, common.stored(_linked(bands, first, threshold, tolerance), "links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                    tolerance: float = TOLERANCE) -> DataFrame:
    """One row per document: doc_id, class_id (smallest document of its
    connected component), text_id (smallest document of equal text), n_links
    (different texts linked to its own)."""
    return _classified(docs, id_col, text_col, threshold, tolerance).select(
        common.id_of("_id").alias("doc_id"), common.id_of("_class").alias("class_id"),
        common.id_of("_first").alias("text_id"), F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"))


def _classified(docs: DataFrame, id_col: str, text_col: str, threshold: float, tolerance: float) -> DataFrame:
    """``(_id, _node, _first, _class, _links)`` of each document."""
    nodes, links = join_texts(docs, id_col, text_col, threshold, tolerance)
    first = nodes.select("_node", "_first")
    counts = links.filter("_b IS NULL").groupBy(F.col("_a").alias("_node")).agg(F.sum("_n").alias("_links"))
    edges = (links.filter("_b IS NOT NULL").select("_a", "_b").distinct()
             .join(first.select(F.col("_node").alias("_a"), F.col("_first").alias("u")), "_a")
             .join(first.select(F.col("_node").alias("_b"), F.col("_first").alias("v")), "_b").select("u", "v"))
    keyed = _keyed(docs, id_col, text_col).select("_id", "_node").distinct()
    # an id with several texts holds them together
    split = keyed.groupBy("_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    held = keyed.join(split, "_id", "left_semi").join(first, "_node").select(
        F.col("_id").alias("u"), F.col("_first").alias("v"))
    found = components(edges.unionByName(held)).select(F.col("vertex").alias("_first"), F.col("component").alias("_class"))
    classed = (first.join(counts, "_node", "left").join(found, "_first", "left")
               .withColumn("_class", F.coalesce("_class", "_first")))
    return keyed.join(classed, "_node")


def one_per_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                  tolerance: float = TOLERANCE) -> DataFrame:
    """The rows of ``docs`` (all columns) that stand for their class: its
    smallest document, once."""
    found = _classified(docs, id_col, text_col, threshold, tolerance).select("_id", "_node", "_class")
    found = common.stored(found, "classes")
    best = found.groupBy("_class").agg(F.min(F.struct("_id", "_node")).alias("_best"))
    gone = (found.join(best, "_class").filter("_id != _best._id or _node != _best._node")
            .select(F.col("_id").alias("_gone"), F.col("_node").alias("_gone_node")))
    node = F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))
    gone = checked(common.stored(gone, "duplicates"))
    left = docs.join(gone, (common.key_of(id_col) == F.col("_gone")) & (node == F.col("_gone_node")), "left_anti")
    if docs.count() == found.count():       # no row is repeated
        return left
    return (left.withColumn("_id", common.key_of(id_col)).withColumn("_node", node)
            .dropDuplicates(["_id", "_node"]).drop("_id", "_node"))
