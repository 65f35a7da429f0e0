"""Benchmark decontamination by size-partitioned MinHash containment search.

Finds short test items inside long documents: an item leaks into a document
that holds at least ``threshold`` of the item's distinct word shingles.  Built
from DataFrame functions only.

Search: items are partitioned by size class (power of two of their shingle
count).  A document with containment t lacks at most ``n - ceil(t n)`` of an
item's n shingles, so of any ``s`` of them it holds at least
``s - (n - ceil(t n))``.  Each item is sketched by its s shingles of smallest
hash, with s just above the most that items of its size class may lack: far
fewer than n, and still no leak can be missed whatever the document's length
(a plain MinHash of a long document would be swamped by its other shingles).
Documents stream their shingle hashes past the sketches; pairs with enough
hits are candidates.

Verification: the shingles of candidate documents are compared with the
item's as strings, so hash collisions cannot make a leak.

The bytes of broadcast sides are summed first (``MAX_BROADCAST_BYTES``); larger
ones are joined by shuffle with the same result.

Edge cases: a null or empty text has no shingles and neither leaks nor is
found; an item of fewer than five words is one shingle of all its words;
several rows of one id (document or item) are one text with all their
shingles; null ids are one id, null in the result; empty tables give an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from unitcast.llm import common
from unitcast.operators.joins import stored_bytes

WORDS = 5
THRESHOLD = 0.8
SPARE = 3                        # sketch shingles beyond the most that may be lacking, plus one
MAX_BROADCAST_BYTES = 32 << 20   # of values; Spark's hash table takes about three times that


def words(text: Column) -> Column:
    """Lower-case words: runs of letters and digits."""
    return F.filter(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def shingle_hashes(w: Column, size: int) -> Column:
    """Distinct 64-bit hashes of the runs of ``size`` words."""
    one = lambda i: F.xxhash64(F.lit(size), *[F.get(w, i + k) for k in range(size)])
    return _runs(w, size, one, "array<bigint>")


def shingle_texts(w: Column, size: int) -> Column:
    return _runs(w, size, lambda i: F.concat_ws(" ", F.slice(w, i + 1, size)), "array<string>")


def _runs(w: Column, size: int, one, kind: str) -> Column:
    return F.when(F.size(w) >= size, F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(w) - size), one))
                  ).otherwise(F.array().cast(kind))


def checked(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """A stored frame, with a broadcast hint only if its summed bytes allow."""
    return F.broadcast(df) if stored_bytes(df) <= max_bytes else df


def _items(benchmark: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``(_item, _size, _shingle)``: distinct shingles of every item."""
    w = (common.texts(benchmark, id_col, text_col).select(F.col("_id").alias("_item"), words(F.col("_text")).alias("_w"))
         .withColumn("_size", F.least(F.lit(size), F.size("_w"))).filter("_size > 0"))
    run = F.when(F.col("_size") == size, shingle_texts(F.col("_w"), size)).otherwise(F.array(F.concat_ws(" ", "_w")))
    return w.select("_item", "_size", F.explode(run).alias("_shingle")).distinct()


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", size: int = WORDS,
               threshold: float = THRESHOLD) -> DataFrame:
    """One row per (document, item) with containment of at least
    ``threshold``: doc_id, item_id, matched, n_shingles, containment."""
    items = common.stored(_items(benchmark, item_col, item_text_col, size), "items")
    sizes = sorted(r[0] for r in items.select("_size").distinct().collect())      # at most ``size`` rows
    need = F.ceil(F.col("_n") * F.lit(threshold) - F.lit(1e-9)).cast("long")
    counts = items.groupBy("_item").agg(F.count(F.lit(1)).alias("_n")).withColumn("_need", need)

    parts = F.split("_shingle", " ")
    hashed = F.lit(None).cast("long")
    for k in sizes:
        hashed = F.when(F.col("_size") == k, F.xxhash64(F.lit(k), *[F.get(parts, F.lit(i)) for i in range(k)])).otherwise(hashed)
    # size class: the most that any item of the class may lack
    largest = F.pow(F.lit(2), F.floor(F.log2("_n")) + 1) - 1
    lacking = (largest - F.ceil(largest * F.lit(threshold) - F.lit(1e-9))).cast("long")
    sketch = (items.withColumn("_h", hashed).join(counts, "_item")
              .withColumn("_k", F.least(F.col("_n"), lacking + 1 + SPARE))
              .withColumn("_rank", F.row_number().over(Window.partitionBy("_item").orderBy("_h", "_shingle")))
              .filter("_rank <= _k")
              .select("_h", "_item", (F.col("_k") - (F.col("_n") - F.col("_need"))).alias("_hits")))
    sketch = checked(common.stored(sketch, "sketches"))

    plain = common.texts(docs, id_col, text_col)
    w = plain.select("_id", words(F.col("_text")).alias("_w"))
    # explode_outer: a plain explode would first filter on the shingles' size and
    # so split every text anew for each word; its null rows fall out of the join
    streams = [w.select("_id", F.explode_outer(shingle_hashes(F.col("_w"), k)).alias("_h")) for k in sizes]
    found = None
    for s in streams:
        hits = s.join(sketch, "_h").select("_id", "_item", "_h", "_hits")
        found = hits if found is None else found.unionByName(hits)
    if found is None:       # no items
        found = plain.select("_id", F.lit(0).cast("long").alias("_item"), F.lit(0).cast("long").alias("_h"),
                             F.lit(0).cast("long").alias("_hits")).limit(0)
    pairs = (found.groupBy("_id", "_item").agg(F.count_distinct("_h").alias("_found"), F.min("_hits").alias("_hits"))
             .filter("_found >= _hits").select("_id", "_item"))
    pairs = common.stored(pairs, "candidates")

    ids = checked(common.stored(pairs.select("_id").distinct(), "candidate-ids"))
    near = plain.join(ids, "_id", "left_semi").select("_id", words(F.col("_text")).alias("_w"))
    runs = F.flatten(F.array(*[shingle_texts(F.col("_w"), k) for k in sizes])) if sizes else F.array().cast("array<string>")
    held = near.select("_id", F.explode_outer(runs).alias("_shingle"))
    wanted = checked(items.select("_item", "_shingle"))
    matched = (held.join(wanted, "_shingle").join(pairs, ["_id", "_item"], "left_semi")
               .groupBy("_id", "_item").agg(F.count_distinct("_shingle").alias("_matched")))
    return (matched.join(counts, "_item").filter(F.col("_matched") >= F.col("_need"))
            .select(common.id_of("_id").alias("doc_id"), common.id_of("_item").alias("item_id"),
                    F.col("_matched").alias("matched"), F.col("_n").alias("n_shingles"),
                    (F.col("_matched") / F.col("_n")).alias("containment")))


def without_leaks(docs: DataFrame, leaks: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose document holds no test item."""
    gone = common.stored(leaks.select(common.key_of("doc_id").alias("_gone")).distinct(), "leaked-ids")
    return docs.join(checked(gone), common.key_of(id_col) == F.col("_gone"), "left_anti")
