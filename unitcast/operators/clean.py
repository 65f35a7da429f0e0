"""Cleaning operators: B4, B6-B8, B12-B17, C1, C2, G7."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from unitcast.functions.columns import col
from unitcast.operators.joins import materialize

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
           T.DoubleType, T.DecimalType)


def clean_outliers(df: DataFrame, price_gt: float | None = None,
                   price_lt: float | None = None, count_lt: float | None = None,
                   price: str = "item_price", count: str = "item_cnt_day") -> DataFrame:
    """Keep rows with price_gt < price < price_lt and count < count_lt."""
    cond = F.lit(True)
    if price_gt is not None:
        cond = cond & (F.col(price) > price_gt)
    if price_lt is not None:
        cond = cond & (F.col(price) < price_lt)
    if count_lt is not None:
        cond = cond & (F.col(count) < count_lt)
    return df.filter(cond)


def _select_rank(values: DataFrame, k: int, n: int, max_exact: int,
                 accuracy: int) -> float:
    """Value of 0-based rank ``k`` among ``n`` non-null values of column ``v``.

    Narrows a bracket around the rank with ``percentile_approx`` (distributed,
    bounded sketch), counts exactly what lies below it, and recurses into the
    bracket until at most ``max_exact`` values remain; those are reduced to
    (value, count) pairs and scanned in order.  No step holds more than
    ``max_exact`` values in one task.
    """
    eps = 2.0 / accuracy
    while n > max_exact:
        q = k / max(n - 1, 1)
        lo_q, hi_q = max(q - eps, 0.0), min(q + eps, 1.0)
        lo, hi = values.agg(F.percentile_approx("v", [lo_q, hi_q], accuracy)).first()[0]
        stats = values.agg(
            F.sum(F.when(F.col("v") < lo, 1).otherwise(0)).alias("below"),
            F.sum(F.when(F.col("v").between(lo, hi), 1).otherwise(0)).alias("inside"),
        ).first()
        below, inside = int(stats.below or 0), int(stats.inside or 0)
        if below <= k < below + inside and inside < n:
            # Store the (much smaller) bracket: the next round reads only it.
            values = materialize(values.filter(F.col("v").between(lo, hi)))
            k, n = k - below, inside
        elif eps >= 0.5:
            break
        else:
            eps *= 4
    counts = values.groupBy("v").agg(F.count(F.lit(1)).alias("c"))
    w = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    row = (counts.withColumn("upto", F.sum("c").over(w))
           .filter(F.col("upto") > k).orderBy("v").first())
    return float(row.v)


def exact_median(df: DataFrame, c: str, max_exact: int = 200_000,
                 accuracy: int = 10_000) -> float | None:
    """Exact median (mean of the two middle values for even n)."""
    values = df.select(F.col(c).cast("double").alias("v")).filter(F.col("v").isNotNull())
    n = values.count()
    if n == 0:
        return None
    if n > max_exact:   # several passes follow: read stored values, not the source
        values = materialize(values)
    lo = _select_rank(values, (n - 1) // 2, n, max_exact, accuracy)
    hi = lo if n % 2 == 1 else _select_rank(values, n // 2, n, max_exact, accuracy)
    return (lo + hi) / 2.0


def median_frame(df: DataFrame, c: str, name: str = "median", **kw) -> DataFrame:
    """One-row frame holding the exact median of ``c``."""
    m = exact_median(df, c, **kw)
    return df.sparkSession.createDataFrame([(m,)], T.StructType([T.StructField(name, T.DoubleType())]))


def repair_price(df: DataFrame, bad, value: float | None,
                 price: str = "item_price") -> DataFrame:
    """Replace ``price`` by ``value`` where ``bad`` holds."""
    return df.withColumn(price, F.when(col(bad), F.lit(value)).otherwise(F.col(price)))


def remap_keys(df: DataFrame, mapping: dict, key: str = "shop_id") -> DataFrame:
    """Rewrite duplicate keys through a literal map (no join needed)."""
    if not mapping:
        return df
    m = F.create_map(*[F.lit(x) for kv in sorted(mapping.items()) for x in kv])
    return df.withColumn(key, F.coalesce(F.element_at(m, F.col(key)), F.col(key))
                         .cast(df.schema[key].dataType))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def fill_numeric(df: DataFrame, value: float = 0.0, cols: list[str] | None = None) -> DataFrame:
    """Fill NULL numerics with a constant (strings are left alone)."""
    cols = cols or numeric_columns(df)
    return df.na.fill(value, subset=cols)


def fill_from(df: DataFrame, target: str, *sources) -> DataFrame:
    """Cascading fill from other columns."""
    return df.withColumn(target, F.coalesce(F.col(target), *[col(s) for s in sources]))


def complete_cases(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Drop rows with any NULL."""
    return df.na.drop("any", subset=cols)


def null_profile(df: DataFrame) -> DataFrame:
    """B16 (re-aimed): NULL count per column, long form (column_name, null_count)."""
    aggs = [F.sum(F.col(c).isNull().cast("bigint")).alias(f"c{i}") for i, c in enumerate(df.columns)]
    stack = ", ".join(f"'{c}', c{i}" for i, c in enumerate(df.columns))
    return (df.agg(*aggs)
            .selectExpr(f"stack({len(df.columns)}, {stack}) as (column_name, null_count)")
            .withColumn("null_count", F.coalesce(F.col("null_count"), F.lit(0)).cast("bigint")))


def log_target(df: DataFrame, c: str, name: str | None = None) -> DataFrame:
    """log1p of a column."""
    return df.withColumn(name or c, F.log1p(F.col(c)))


def unlog(df: DataFrame, c: str, name: str | None = None) -> DataFrame:
    return df.withColumn(name or c, F.expm1(F.col(c)))


def dedupe_keep_first(df: DataFrame, subset: list[str], order: list[str]) -> DataFrame:
    """One row per ``subset`` key, the first in ``order``.

    A min over a struct led by the order columns is an ordinary aggregate,
    so it combines map-side: a key holding a third of the rows is reduced in
    every task before the shuffle instead of being sorted in one window.
    """
    rest = [c for c in df.columns if c not in subset and c not in order]
    best = F.min(F.struct(*[F.col(c) for c in order + rest])).alias("_first")
    out = df.groupBy(*subset).agg(best)
    return out.select(*subset, *[F.col(f"_first.{c}").alias(c) for c in order + rest]).select(*df.columns)


# Category super-groups by id range (inclusive), in the
# reference's order.  Unlisted ids keep their own name.
CATEGORY_GROUPS = [
    (1, 7, "Access"),
    (10, 17, "Consoles"),
    (18, 24, "Consoles Games"),
    (26, 27, "phone games"),
    (28, 31, "CD games"),
    (32, 36, "Card"),
    (37, 42, "Movie"),
    (43, 54, "Books"),
    (55, 60, "Music"),
    (61, 72, "Gifts"),
    (73, 78, "Soft"),
]


def category_groups(df: DataFrame, ranges=CATEGORY_GROUPS, id_col: str = "item_category_id",
                    name_col: str = "item_category_name", out: str = "cats") -> DataFrame:
    """Regroup categories by id range; a CASE expression, no join."""
    expr = None
    for lo, hi, label in ranges:
        cond = F.col(id_col).between(lo, hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return df.withColumn(out, expr.otherwise(F.col(name_col)))
