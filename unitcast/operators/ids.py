"""Consecutive 0-based numbering in a given order, without a global window.

``row_number() over (order by k)`` with no partition runs in one task.  Here
the rows are range-partitioned on the order key, sorted inside each partition
and stored with ``monotonically_increasing_id``, which carries the partition
index in its upper 31 bits and the row's position in its lower 33 bits.  The
stored rows are then shifted by the row count of all earlier partitions (a
table with one row per partition).  Offsets and ids read the same stored rows,
so they always fit together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_LOW33 = (1 << 33) - 1


def consecutive_ids(df: DataFrame, order_cols: list[str], name: str = "id",
                    partitions: int | None = None) -> DataFrame:
    """Append ``name`` = 0..n-1 following ``order_cols`` (must be unique)."""
    from unitcast.operators.joins import materialize
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
                         .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = (ranged.withColumn("_pid", F.shiftright("_mid", 33))
              .withColumn("_rn", F.col("_mid").bitwiseAND(F.lit(_LOW33))))
    offsets = (ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
               .withColumn("_off", F.coalesce(
                   F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(
                       Window.unboundedPreceding, -1)), F.lit(0)))
               .select("_pid", "_off"))
    return (ranged.join(F.broadcast(offsets), "_pid")
            .withColumn(name, (F.col("_off") + F.col("_rn")).cast("bigint"))
            .drop("_mid", "_pid", "_rn", "_off"))
