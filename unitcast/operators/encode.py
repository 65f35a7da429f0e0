"""Label encoding (G6) and value-domain unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from unitcast.operators.ids import consecutive_ids
from unitcast.operators.joins import checked_broadcast


def union_domain(*frames: DataFrame, c: str) -> DataFrame:
    """Distinct values of ``c`` over several frames."""
    parts = [f.select(F.col(c).alias("value")) for f in frames]
    return reduce(DataFrame.union, parts).filter(F.col("value").isNotNull()).distinct()


def encode_fit(*frames: DataFrame, c: str, code: str = "code") -> DataFrame:
    """G6 fit: sorted distinct values (binary order) -> 0-based code.
    Numbered without a global window (see ``consecutive_ids``)."""
    domain = union_domain(*frames, c=c)
    return consecutive_ids(domain, ["value"], code)


def encode_apply(df: DataFrame, c: str, codes: DataFrame, out: str | None = None,
                 unknown: int = -1, code: str = "code") -> DataFrame:
    """G6 apply: replace values by codes; values outside the domain get
    ``unknown`` (the reference's fill made them collide with code 0)."""
    out = out or c
    # A code table has one row per distinct value: broadcast it when that
    # count is proven small, so the (large) encoded side is not shuffled.
    m, _ = checked_broadcast(codes.select(F.col("value").alias("_v"), F.col(code).alias("_code")))
    joined = df.join(m, df[c] == m["_v"], "left")
    return (joined.withColumn(out, F.coalesce(F.col("_code"), F.lit(unknown)).cast("bigint"))
            .drop("_v", "_code"))


def label_encode(df: DataFrame, c: str, out: str | None = None, unknown: int = -1) -> DataFrame:
    return encode_apply(df, c, encode_fit(df, c=c), out=out, unknown=unknown)
