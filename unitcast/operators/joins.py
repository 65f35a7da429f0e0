"""Materialisation and size-checked broadcast."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from unitcast import config

_written: list[tuple[str, str]] = []     # (table or "", path) written by this process

#: Rows of a task whose hash map or sort holds about one entry per row.
TASK_ROWS = 500_000


def in_tasks(rows: DataFrame, keys: list[str], task_rows: int = TASK_ROWS) -> DataFrame:
    """``rows`` dealt by ``keys`` over as many tasks as they fill, one per slot
    at least.  For keys of few rows each: the next aggregates on (at least) the
    keys run in these tasks, so their maps stay the same size however large
    the table and its scan splits are.  Counts the rows first."""
    slots = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(slots, -(-rows.count() // task_rows)), *keys)


def materialize(df: DataFrame, **options: str) -> DataFrame:
    """Write ``df`` as parquet into the shared checkpoint folder and read it.

    The files survive executor loss, let later steps reuse the result instead
    of recomputing the scans and shuffles behind it, and are read with column
    pruning, pushed-down filters and statistics.  ``options`` go to the writer.
    """
    spark = df.sparkSession
    path = config.scratch_path(spark, f"stored-{uuid.uuid4().hex}")
    df.write.options(**options).parquet(path)
    _written.append(("", path))
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a frame stored by ``materialize`` that nothing reads any more."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        own = [w for w in _written if w[1].rsplit("/", 1)[-1] == path.rsplit("/", 1)[-1]]
        for w in own:
            p = jvm.org.apache.hadoop.fs.Path(w[1])
            p.getFileSystem(conf).delete(p, True)
            _written.remove(w)


def stored_bytes(df: DataFrame) -> int:
    """Bytes that the rows of ``df`` take in memory: 16 per row and column
    plus the contents of strings and binaries (one aggregate)."""
    wide = [F.coalesce(F.octet_length(f"`{c}`"), F.lit(0)) for c, t in df.dtypes if t in ("string", "binary")]
    row = F.lit(16 * len(df.columns)).cast("long")
    for w in wide:
        row = row + w
    return df.agg(F.sum(row)).first()[0] or 0


def checked_broadcast(df: DataFrame, max_bytes: int = config.BROADCAST_MAX_BYTES,
                      materialized: bool = False) -> tuple[DataFrame, bool]:
    """Broadcast ``df`` only when its measured size is at most ``max_bytes``.

    The frame is materialised first (unless it already is), so the size
    check and the later join read the same stored rows.  Returns the frame
    (hinted or not) and whether it was broadcast; beyond the bound the caller
    gets a plain frame and the join shuffles.
    """
    if not materialized:
        df = materialize(df)
    if stored_bytes(df) > max_bytes:
        return df, False
    return F.broadcast(df), True


def materialize_bucketed(df: DataFrame, keys: list[str], order: list[str] | None = None,
                         buckets: int | None = None) -> DataFrame:
    """Write ``df`` as a table bucketed (and sorted) by ``keys`` in the shared
    checkpoint folder and read it back.  The bucketed scan reports hash
    partitioning on ``keys``, so windows, aggregates and joins on those keys
    run without another exchange.  ``buckets`` defaults to the session's
    shuffle partitions; callers that know the row count pass their own."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"unitcast_{uuid.uuid4().hex}"
    path = config.scratch_path(spark, name)
    df.write.bucketBy(n, *keys).sortBy(*(order or keys)).option("path", path).saveAsTable(name)
    _written.append((name, path))
    return spark.table(name)


def release(spark: SparkSession) -> None:
    """Drop the tables and delete the folders written by ``materialize`` and
    ``materialize_bucketed``.  Call it when no result that reads them is
    needed any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _written:
        name, path = _written.pop()
        if name:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
