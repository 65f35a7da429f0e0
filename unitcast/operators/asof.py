"""Means as of each month (E4, E6, F8): what was known before the row's month.

Running exact sums and counts over a range frame that ends one month before
the row, instead of one cut-off for all rows, so no row sees its own or a
later month.  Windows are by pair (at most a row per month) and by item over
item-months, aggregated before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

T, S, I = "date_block_num", "shop_id", "item_id"
EXACT = "decimal(28,10)"


def before(*keys: str) -> Window:
    """All earlier months of the same key."""
    return Window.partitionBy(*keys).orderBy(T).rangeBetween(Window.unboundedPreceding, -1)


def _mean(total, count) -> F.Column:
    return total.cast("double") / F.nullif(count, F.lit(0))


def as_of_means(monthly: DataFrame, sales: DataFrame, value: str = "item_cnt_month", price: str = "item_price") -> DataFrame:
    """``monthly`` (month, shop, item, value; one row each) with the pair's
    mean value over its earlier months, its value of the month before (null
    without a row), and the item's mean price over earlier months' ``sales``."""
    pair, last = before(S, I), Window.partitionBy(S, I).orderBy(T).rangeBetween(-1, -1)
    exact = F.col(value).cast(EXACT)
    rows = monthly.select(T, S, I, value, _mean(F.sum(exact).over(pair), F.count(value).over(pair)).alias(f"{value}_mean_as_of"),
                          F.max(value).over(last).alias("item_cnt_prev_month"))
    prices = sales.groupBy(T, I).agg(F.sum(F.col(price).cast(EXACT)).alias("_s"), F.count(price).alias("_n"))
    # months of the item in either table, so that a month with units only has its row too
    months = prices.unionByName(monthly.select(T, I).distinct(), allowMissingColumns=True).groupBy(T, I).agg(F.max("_s").alias("_s"), F.max("_n").alias("_n"))
    item = months.select(T, I, _mean(F.sum("_s").over(before(I)), F.sum("_n").over(before(I))).alias("item_price_mean_as_of"))
    return rows.join(item, [T, I], "left").select(T, S, I, value, f"{value}_mean_as_of", "item_cnt_prev_month", "item_price_mean_as_of")
