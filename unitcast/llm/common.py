"""Small helpers shared by the corpus operators.

Null document ids: a null id counts as one document whose id is after all
others (``LAST_ID`` inside the operators, null again in results).
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from unitcast import config

LAST_ID = (1 << 63) - 1
BATCH_ROWS = 1000       # rows that Spark sends to a Python worker at a time


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that
    functions used in tasks import the same code wherever they run."""
    import os
    import tempfile
    import zipfile
    import unitcast
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.abspath(unitcast.__file__))
    path = os.path.join(tempfile.mkdtemp(), "unitcast.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(d, n), os.path.join("unitcast", os.path.relpath(os.path.join(d, n), root)))
    spark.sparkContext.addPyFile(path)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":    # the default: much for whole texts
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    _shipped.add(app)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder."""
    return config.scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet into the shared folder and read it back."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def key_of(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID))


def id_of(key: str) -> Column:
    return F.when(F.col(key) != LAST_ID, F.col(key))


def texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(_id, _text)``: id with nulls last, null text as empty text."""
    return df.select(key_of(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))


class Recent(dict):
    """A dict that computes missing values (``compute``) and keeps at least
    the ``entries()`` keys used last, at most twice as many."""

    def __init__(self):
        self.older: dict = {}

    def entries(self) -> int:
        raise NotImplementedError

    def compute(self, key):
        raise NotImplementedError

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.entries():
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to at most ``rows`` rows, so that what a task derives
    from a batch stays small however long the texts are."""
    try:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield batch.slice(at, rows)
    finally:
        give_back()


def give_back() -> None:
    """Return freed memory to the system: a worker lives on after its task, and
    what it keeps is missing elsewhere on the executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
    if trim is not None:
        trim(0)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_cuts(df: DataFrame, key: str, parts: int) -> list[int]:
    """At most ``parts - 1`` ascending cut points that split ``key`` into
    ranges of about equal row counts (only these scalars reach the driver)."""
    if parts < 2:
        return []
    q = df.stat.approxQuantile(key, [i / parts for i in range(1, parts)], 1.0 / (4 * parts))
    return sorted({min(int(x), LAST_ID) for x in q})


def range_of(key: str, cuts: list[int]) -> Column:
    """Number of the id range (0 ..) that ``key`` falls into."""
    edges = np.array(cuts, dtype="int64")

    @F.pandas_udf("int")
    def locate(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, ids.to_numpy(dtype="int64"), side="right").astype("int32"))

    return locate(F.col(key)) if cuts else F.lit(0)


def running_starts(counts: DataFrame, group: str, order: str, value: str, name: str) -> DataFrame:
    """Exclusive running sum of ``value`` over (group, order): a window inside
    each group plus the offsets of the groups before it.  Groups are few
    (ranges), their members spread over tasks."""
    inner = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    totals = (counts.groupBy(group).agg(F.sum(value).alias("_total"))
              .select(F.col(group).alias("_g"), F.coalesce(F.sum("_total").over(outer), F.lit(0)).alias("_before")))
    return (counts.withColumn("_inside", F.coalesce(F.sum(value).over(inner), F.lit(0)))
            .join(totals, F.col(group) == F.col("_g"))
            .withColumn(name, (F.col("_before") + F.col("_inside")).cast("long"))
            .drop("_before", "_inside", "_g"))
