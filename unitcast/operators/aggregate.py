"""Aggregations, pivots and metrics: E1-E18."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from unitcast.functions.columns import exact_mean, exact_sum, rnd
from unitcast.operators.joins import in_tasks

MONTH_KEYS = ("date_block_num", "shop_id", "item_id")


def monthly_sales(df: DataFrame, keys=MONTH_KEYS, value: str = "item_cnt_day",
                  name: str = "item_cnt_month") -> DataFrame:
    """Sum of units per key set (partial aggregation map-side)."""
    keys = [k if isinstance(k, str) else k for k in keys]
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def monthly_of_pairs(sales: DataFrame) -> DataFrame:
    """E2 where a pair has few rows (shop x item): narrow rows are dealt by
    pair, so that no scan task holds a map of nearly all its rows, and
    aggregates per pair need no further exchange."""
    return monthly_sales(in_tasks(sales.select(*MONTH_KEYS, "item_cnt_day"), ["shop_id", "item_id"]))


def sum_all_but(df: DataFrame, measure: str, name: str) -> DataFrame:
    """Group by every column except ``measure``."""
    keys = [c for c in df.columns if c != measure]
    return df.groupBy(*keys).agg(F.sum(measure).alias(name))


def mean_by(df: DataFrame, keys, value: str, name: str, as_of_month: int | None = None,
            time_col: str = "date_block_num", exact: bool = False) -> DataFrame:
    """Mean of ``value`` per key; optional cutoff month (no leakage).
    ``exact`` sums in decimal first (order-independent result for prices)."""
    if as_of_month is not None:
        df = df.filter(F.col(time_col) <= as_of_month)
    mean = exact_mean(value) if exact else F.avg(value)
    return df.groupBy(*keys).agg(mean.alias(name))


def with_scalar(df: DataFrame, scalar: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row as scalar
    subqueries (evaluated once, then used as a constant in every task)."""
    for c in scalar.columns:
        df = df.withColumn(c, scalar.select(c).scalar())
    return df


def share_index(df: DataFrame, key: str, value: str, name: str = "share") -> DataFrame:
    """Per-key sum divided by the mean of the per-key sums.

    Aggregated first; the mean is a one-row aggregate broadcast back, so no
    un-partitioned window ever sees the fact table.  Sums are exact decimals,
    so the result does not depend on the order partial sums are combined.
    """
    sums = df.groupBy(key).agg(exact_sum(value).alias("_sum"))
    mean = sums.agg((exact_sum("_sum") / F.nullif(F.count("_sum"), F.lit(0))).alias("_mean"))
    return (with_scalar(sums, mean)
            .select(key, (F.col("_sum") / F.nullif(F.col("_mean"), F.lit(0.0))).alias(name)))


_CELL = {"sum": F.sum, "avg": F.avg, "mean": F.avg, "count": F.count}


def month_cells(df: DataFrame, keys, column: str, value: str, agg: str = "sum", dealt: bool = False) -> DataFrame:
    """One row per key with its aggregated cells ``_cells``, a list of (month,
    value): only months with rows take room, through the shuffle and in a task.
    ``dealt``: the rows come dealt by key already (``monthly_of_pairs``)."""
    rows = df.select(*keys, column, value)
    cells = (rows if dealt else in_tasks(rows, list(keys))).groupBy(*keys, column).agg(_CELL[agg](value).alias("_value"))
    cell = F.when(F.col(column).isNotNull(), F.struct(F.col(column).alias("_month"), "_value"))
    return cells.groupBy(*keys).agg(F.collect_list(cell).alias("_cells"))


def spread_months(cells: DataFrame, domain, fill=None, prefix: str = "m_") -> DataFrame:
    """``_cells`` as the last columns, one per month of ``domain``; ``fill``
    (if given) where a month has no cell, a null or a NaN.  A batch of rows is
    laid out at a time, by position: no plan expression per month."""
    domain, at = list(domain), cells.columns.index("_cells")
    kept = [f for f in cells.schema.fields if f.name != "_cells"]
    if not domain:
        return cells.drop("_cells")
    month, kind = (cells.schema["_cells"].dataType.elementType[n].dataType for n in ("_month", "_value"))
    schema = T.StructType([*kept, *[T.StructField(f"{prefix}{d}", kind) for d in domain]])
    wanted = pa.array(domain, to_arrow_type(month))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(at)
            flat = lists.flatten()
            rows = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
            months = pc.fill_null(pc.index_in(flat.field("_month"), value_set=wanted), -1).to_numpy(zero_copy_only=False)
            held = np.flatnonzero(months >= 0)
            cell = np.full((len(domain), len(lists)), -1, dtype=np.int64)
            cell[months[held], rows[held]] = held
            values = flat.field("_value")
            out = [values.take(pa.array(c, mask=c < 0)) for c in cell]
            if fill is not None:
                empty = [pc.is_null(c, nan_is_null=pa.types.is_floating(c.type)) for c in out]
                out = [pc.if_else(e, pa.scalar(fill).cast(c.type), c) for e, c in zip(empty, out)]
            yield pa.record_batch([*[c for i, c in enumerate(batch.columns) if i != at], *out], names=schema.names)

    return cells.mapInArrow(run, schema)


def pivot_months(df: DataFrame, keys, column: str, value: str, agg: str = "sum",
                 domain=None, fill=0.0, prefix: str = "m_", dealt: bool = False) -> DataFrame:
    """One column per month.  Without ``domain`` it is every month
    from the first to the last in the data (two scalars), so no row is left
    out.  Narrow rows are dealt by key in a single exchange and aggregated per
    month; the months become columns of the rows that are handed on."""
    if domain is None:
        lo, hi = df.agg(F.min(column), F.max(column)).first()
        domain = [] if lo is None else range(lo, hi + 1)
    cells = month_cells(df, keys, column, value, agg, dealt)
    if agg == "count":      # no row: a count of 0
        fill = 0 if fill is None else fill
    return spread_months(cells, domain, fill, prefix)


def rmse(df: DataFrame, label: str, pred: str, name: str = "rmse") -> DataFrame:
    """Root mean squared error as a one-row frame (exact decimal sum)."""
    e = F.col(label) - F.col(pred)
    return (df.select((e * e).alias("_se"))
            .agg(F.sqrt(F.try_divide(exact_sum("_se"), F.count("_se"))).alias(name)))


def r2_percent(df: DataFrame, label: str, pred: str, name: str = "r2_percent") -> DataFrame:
    """Coefficient of determination x 100, rounded to 2 places (exact
    decimal sums); NULL for a constant label."""
    stats = df.agg(F.avg(label).alias("_mu"))
    e, d = F.col(label) - F.col(pred), F.col(label) - F.col("_mu")
    sums = with_scalar(df, stats).agg(exact_sum(e * e).alias("_sse"), exact_sum(d * d).alias("_sst"))
    return sums.select(rnd((1 - F.try_divide("_sse", "_sst")) * 100, 2).alias(name))


def table_shape(df: DataFrame) -> DataFrame:
    """(n_rows, n_cols)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_cols", F.lit(len(df.columns)).cast("bigint"))


def output_means(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Mean of every (numeric) output column."""
    from unitcast.operators.clean import numeric_columns
    cols = cols or numeric_columns(df)
    return df.agg(*[F.avg(c).alias(f"mean_{c}") for c in cols])
