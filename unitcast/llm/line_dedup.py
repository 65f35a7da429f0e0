"""Line dedup with levelled sorted runs of line hashes.

``LineRuns`` keeps the hashes of all lines seen so far as sorted runs, each a
table bucketed and sorted by hash.  A new batch of lines is merge-anti-joined
with every run (same buckets, so no run is ever shuffled); hashes not found
become the batch's own run on level 0.  When a level holds ``fanout`` runs
they are merged into one run on the next level, so a store of n batches has
O(fanout * log n) runs and each hash is rewritten O(log n) times.

``dedup_lines`` feeds a table in batches of ascending id ranges: a line's
first holder is then the smallest document id holding it.  A hot line is
reduced by the map-side combine of ``min(id)`` before the shuffle, and the
decision join is on (hash, id).  The hashes to drop are collected by id and
text, so no array exceeds the lines of one text, however many rows an id has.

Semantics: lines are split at ``\\n``; a line's key is the line stripped of
``[\\x20\\x09-\\x0D]`` at both ends with A-Z lower-cased.  Keys shorter than
``min_chars`` code points are never dropped.  A document loses all lines of a
key whose first holder is another document; the first holder keeps all its own.

Edge cases: a null or empty text is one empty line; a null id is one document
after all others; repeated rows of one id are one document and get the same
decisions; an empty table gives an empty result; extra columns are kept.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from unitcast.llm import common

MIN_CHARS = 10      # shorter keys are kept everywhere
BATCHES = 4         # id ranges a table is fed in
FANOUT = 2          # runs of a level that are compacted into one

_STRIP = " \t\n\x0b\x0c\r"


def line_key(line: str, min_chars: int = MIN_CHARS) -> bytes | None:
    """128-bit hash of a line's key, None when the key is too short."""
    key = line.strip(_STRIP)
    return xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass").lower()) if len(key) >= min_chars else None


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(_id, _text_hash, k1, k2)``, once per line key of each row of
    ``(_id, _text_hash, _text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes, keys = [], [], []
            for i, h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                found = {line_key(x, min_chars) for x in text.as_py().split("\n")}
                found.discard(None)
                ids += [i] * len(found)
                hashes += [h] * len(found)
                keys += found
            pair = np.frombuffer(b"".join(keys), dtype="<i8").reshape(-1, 2)
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()), pa.array(pair[:, 0].copy()),
                                   pa.array(pair[:, 1].copy())], names=["_id", "_text_hash", "k1", "k2"])

    return docs.select("_id", "_text_hash", "_text").mapInArrow(run, "_id long, _text_hash long, k1 long, k2 long")


class LineRuns:
    """Levelled sorted runs of line hashes in the shared folder."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or common.shuffle_partitions(spark)
        self.levels: list[list[str]] = []

    @property
    def runs(self) -> list[str]:
        return [r for level in self.levels for r in level]

    def _write(self, df: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (df.write.format("parquet").bucketBy(self.buckets, "k1", "k2").sortBy("k1", "k2")
           .option("path", common.scratch(self.spark, name)).saveAsTable(name))
        return name

    def add(self, lines: DataFrame) -> DataFrame:
        """Anti-join a batch of ``(_id, k1, k2)`` (other columns stay) with all
        runs, add what is new as a run, and return the rows whose lines are to go."""
        fresh = lines.groupBy("k1", "k2").agg(F.min("_id").alias("_id"))
        for run in self.runs:
            fresh = fresh.join(self.spark.table(run).select("k1", "k2").hint("merge"), ["k1", "k2"], "left_anti")
        run = self._write(fresh)
        drops = lines.join(self.spark.table(run), ["k1", "k2", "_id"], "left_anti").distinct()
        drops = common.stored(drops, "line_drops")
        self.levels = self.levels or [[]]
        self.levels[0].append(run)
        self.compact()
        return drops

    def compact(self) -> None:
        """Merge a full level into one run of the next (hashes are disjoint)."""
        for i, level in enumerate(self.levels):
            if len(level) < self.fanout:
                continue
            merged = self.spark.table(level[0])
            for run in level[1:]:
                merged = merged.unionByName(self.spark.table(run))
            new = self._write(merged.repartition(self.buckets, "k1", "k2"))
            if i + 1 == len(self.levels):
                self.levels.append([])
            self.levels[i + 1].append(new)
            for run in level:
                self._drop(run)
            level.clear()

    def _drop(self, run: str) -> None:
        path = self.spark.sql(f"DESCRIBE FORMATTED {run}").filter("col_name = 'Location'").first()["data_type"]
        self.spark.sql(f"DROP TABLE {run}")
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    def close(self) -> None:
        for run in self.runs:
            self._drop(run)
        self.levels = []


def line_drops(docs: DataFrame, min_chars: int = MIN_CHARS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``(_id, _text_hash, _drop)``: per document and text the hashes of its
    lines that go, as one flat array ``[k1, k2, k1, k2, ...]``.  Whether a line
    goes depends on its document alone, so texts of one hash may share a list."""
    spark = docs.sparkSession
    cuts = common.id_cuts(docs, "_id", batches)
    lines = common.stored(line_hashes(docs, min_chars), "line_hashes")
    runs = LineRuns(spark, fanout)
    edges = [None, *cuts, None]
    out = None
    for lo, hi in zip(edges, edges[1:]):
        part = lines
        part = part if lo is None else part.filter(F.col("_id") >= lo)
        part = part if hi is None else part.filter(F.col("_id") < hi)
        drops = runs.add(part)
        out = drops if out is None else out.unionByName(drops)
    runs.close()
    return out.groupBy("_id", "_text_hash").agg(F.flatten(F.collect_list(F.array("k1", "k2"))).alias("_drop"))


def _kept(min_chars: int) -> Column:
    @F.pandas_udf("kept string, n_lines long, n_dropped long")
    def kept(text: pd.Series, drop: pd.Series) -> pd.DataFrame:
        out = []
        for t, d in zip(text, drop):
            lines = t.split("\n")
            if d is None or not len(d):
                out.append((t, len(lines), 0))
                continue
            raw = np.asarray(d, dtype="<i8").tobytes()
            gone = {raw[i:i + 16] for i in range(0, len(raw), 16)}
            left = [x for x in lines if line_key(x, min_chars) not in gone]
            out.append(("\n".join(left), len(lines), len(lines) - len(left)))
        return pd.DataFrame(out, columns=["kept", "n_lines", "n_dropped"])

    return kept(F.col("_text"), F.col("_drop"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """All columns of ``docs`` plus ``_kept`` (struct of kept text, n_lines,
    n_dropped)."""
    keyed = (docs.withColumn("_id", common.key_of(id_col)).withColumn("_text", F.coalesce(F.col(text_col), F.lit("")))
             .withColumn("_text_hash", F.xxhash64("_text")))
    drops = line_drops(keyed.select("_id", "_text_hash", "_text"), min_chars, batches, fanout)
    return (keyed.join(drops, ["_id", "_text_hash"], "left").withColumn("_kept", _kept(min_chars))
            .drop("_id", "_text_hash", "_text", "_drop"))
