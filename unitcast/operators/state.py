"""Carry-forward features (F1, F6, F7): one month is merged into a small state
instead of rebuilding the panel's whole history.

Pair state: (shop_id, item_id, at, ring, last_row, sold).  ``ring[k]`` is the
pair's value k months before ``at`` (null without a panel row), ``last_row``
the latest month with one, ``sold`` whether any value so far was not 0.  Item
state: (item_id, last_row, sold) over the item's panel months.  Both have one
row per key whatever the length of the history, and a month costs one join of
the state with that month's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from unitcast import config

T, S, I = "date_block_num", "shop_id", "item_id"
VALUE = "item_cnt_month"
RING = max(config.COUNT_LAGS)


def _nonzero(value: str) -> F.Column:
    return F.coalesce(F.max(F.col(value) != 0), F.lit(False))


def pair_state(panel: DataFrame, at: int, value: str = VALUE, size: int = RING) -> DataFrame:
    """State after month ``at`` from the panel rows up to it: one map-side
    combined aggregate, no window."""
    cells = [F.max(F.when(F.col(T) == at - k, F.col(value))) for k in range(size)]
    return (panel.filter(F.col(T) <= at).groupBy(S, I)
            .agg(F.array(*cells).alias("ring"), F.max(T).alias("last_row"), _nonzero(value).alias("sold"))
            .select(S, I, F.lit(at).alias("at"), "ring", "last_row", "sold"))


def item_state(panel: DataFrame, at: int, value: str = VALUE) -> DataFrame:
    return panel.filter(F.col(T) <= at).groupBy(I).agg(F.max(T).alias("last_row"), _nonzero(value).alias("sold"))


def advance_pairs(state: DataFrame, month_rows: DataFrame, month: int, value: str = VALUE, size: int = RING) -> DataFrame:
    """Merge the panel rows of one later month; months in between had none.
    A pair without a row ages, a new pair starts."""
    new = month_rows.select(F.col(S).alias("_s"), F.col(I).alias("_i"), F.col(value).alias("_v"))
    both = state.join(new, (F.col(S) == F.col("_s")) & (F.col(I) == F.col("_i")), "full")
    empty = F.array_repeat(F.lit(None).cast("double"), size)
    aged = F.concat(F.array(F.col("_v").cast("double")), F.array_repeat(F.lit(None).cast("double"), F.lit(month - 1) - F.coalesce("at", F.lit(month - 1))),
                    F.coalesce("ring", empty))
    here = F.col("_s").isNotNull()
    return both.select(F.coalesce(S, "_s").alias(S), F.coalesce(I, "_i").alias(I), F.lit(month).alias("at"),
                       F.slice(aged, 1, size).alias("ring"), F.when(here, F.lit(month)).otherwise(F.col("last_row")).alias("last_row"),
                       (F.coalesce("sold", F.lit(False)) | F.coalesce(F.col("_v") != 0, F.lit(False))).alias("sold"))


def advance_items(state: DataFrame, month_rows: DataFrame, month: int, value: str = VALUE) -> DataFrame:
    new = month_rows.groupBy(F.col(I).alias("_i")).agg(_nonzero(value).alias("_nz"))
    both = state.join(new, F.col(I) == F.col("_i"), "full")
    return both.select(F.coalesce(I, "_i").alias(I),
                       F.when(F.col("_i").isNotNull(), F.lit(month)).otherwise(F.col("last_row")).alias("last_row"),
                       (F.coalesce("sold", F.lit(False)) | F.coalesce("_nz", F.lit(False))).alias("sold"))


def features(rows: DataFrame, pairs: DataFrame, items: DataFrame, month: int, lags=config.COUNT_LAGS,
             first_rows: DataFrame | None = None, value: str = VALUE) -> DataFrame:
    """``rows`` (shop_id, item_id, ...) of ``month`` with the lags and the
    recencies that the full panel gives them.  ``pairs`` and ``items`` are the
    states of earlier months.  The item's recency stands on its first row: the
    lowest shop, or the shop that ``first_rows`` (item_id, shop_id) names."""
    age = F.lit(month) - F.col("_at")       # months since the state: 1 if it is current
    held = pairs.select(S, I, F.col("at").alias("_at"), F.col("ring").alias("_ring"), F.col("last_row").alias("_last"), F.col("sold").alias("_sold"))
    seen = items.select(I, F.col("last_row").alias("_item_last"), F.col("sold").alias("_item_sold"))
    first = rows.groupBy(I).agg(F.min(S).alias("_first"))
    if first_rows is not None:
        given = first_rows.select(F.col(I).alias("_gi"), F.col(S).alias("_given"))
        first = first.join(given, F.col(I) == F.col("_gi"), "left").select(I, F.coalesce("_given", "_first").alias("_first"))
    out = rows.join(held, [S, I], "left").join(seen, I, "left").join(first, I, "left")
    at = {k: F.lit(k) - age for k in lags}      # position in the ring
    cells = [F.when((at[k] >= 0) & (at[k] < F.size("_ring")), F.get("_ring", at[k])).alias(f"{value}_lag_{k}") for k in lags]
    pair_gap = F.when(F.col("_sold"), F.lit(month) - F.col("_last")).otherwise(F.lit(-1)).cast("int")
    item_gap = F.when(F.col("_item_sold") & (F.col(S) == F.col("_first")), F.lit(month) - F.col("_item_last")).otherwise(F.lit(-1)).cast("int")
    return out.select(*rows.columns, *cells, pair_gap.alias("item_shop_last_sale"), item_gap.alias("item_last_sale"))
