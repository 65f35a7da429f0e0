"""Dense month x shop x item panel and its ordered features: D4, C4, F1-F9."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from unitcast import config
from unitcast.functions.columns import clip, first_truthy
from unitcast.operators.joins import checked_broadcast, materialize

T, S, I = "date_block_num", "shop_id", "item_id"
DEC = "decimal(28,10)"   # same scale as functions.columns.exact_mean
PAIR = (S, I)


def pair_window(keys=PAIR, time: str = T):
    """Window over one pair's months.  A pair has at most one row per month,
    so a window partition is bounded by the number of months."""
    return Window.partitionBy(*keys).orderBy(F.col(time))


def product(monthly: DataFrame, rows_per_task: int, item_features: DataFrame | None = None) -> DataFrame:
    """(month, shop, item): the shops x items product of each month, with the
    columns of ``item_features`` (month, item, ...) attached to the item side."""
    shops_m = monthly.select(T, S).distinct()
    items_m = monthly.select(T, I).distinct()
    per_month = (shops_m.groupBy(T).agg(F.count(F.lit(1)).alias("ns"))
                 .join(items_m.groupBy(T).agg(F.count(F.lit(1)).alias("ni")), T).collect())   # one row per month
    salts = {r[T]: max(1, -(-r.ns * r.ni // rows_per_task)) for r in per_month}
    salt_of = F.element_at(F.create_map(*[F.lit(x) for kv in sorted(salts.items()) for x in kv]), F.col(T)) \
        if salts else F.lit(1)
    tasks = max(1, sum(salts.values()))
    if item_features is not None:
        items_m = items_m.join(item_features, [T, I], "left")
    big = items_m.withColumn("_salt", F.pmod(F.xxhash64(I), salt_of)).repartition(tasks, T, "_salt")
    small = shops_m.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), (salt_of - 1).cast("bigint"))))
    return big.join(small, [T, "_salt"]).select(T, S, I, *[c for c in items_m.columns if c not in (T, I)])


def dense_panel(monthly: DataFrame, value: str = "item_cnt_month", extra_keys: DataFrame | None = None,
                clip_hi: float = config.CLIP_HI, rows_per_task: int = 2_000_000,
                monthly_stored: bool = False, item_features: DataFrame | None = None) -> DataFrame:
    """Every shop seen in a month x every item seen in that month.

    The product is an equi-join on (month, salt).  Each month gets its own
    salt count from its shop and item counts (one row per month), so that one
    salt stands for about ``rows_per_task`` product rows: the item side is
    hashed into the salts, the shop side replicated per salt, and the item
    side dealt over as many tasks as there are salts.  The explicit number
    keeps the tasks apart although the key tables before the product are tiny.
    ``extra_keys`` (month, shop, item) rows (e.g. the request month) join the
    grid before its single repartition on (shop_id, item_id), the
    partitioning every pair window downstream reuses.  ``value`` is NULL -> 0,
    then clipped.  ``item_features`` (month, item, ...) are joined to the item
    side before the product, so the panel itself meets no further join for
    them; ``extra_keys`` bring such columns along by name or lack them.
    """
    monthly = monthly.select(T, S, I, value)
    if not monthly_stored:   # read three times below: store it once
        monthly = materialize(monthly)
    features = [] if item_features is None else [c for c in item_features.columns if c not in (T, I)]
    grid = product(monthly, rows_per_task, item_features)
    grid = grid.select(T, S, I, F.lit(None).cast("double").alias(value), *features)
    if extra_keys is not None:
        brought = [c for c in features if c in extra_keys.columns]
        grid = grid.unionByName(extra_keys.select(T, S, I, F.lit(None).cast("double").alias(value), *brought),
                                allowMissingColumns=True)
    # Grid keys and observed values meet in one (shop, item) exchange; the
    # per-key max keeps the observed value (grid keys cover every observed
    # key).  An aggregate accepts the (shop, item) partitioning for its
    # (shop, item, month) keys, so no second shuffle, and the pair windows
    # downstream reuse it too.
    # Column-only repartition: AQE may coalesce the partitions (they stay
    # hash-partitioned on the pair) to its advisory size.
    cells = grid.unionByName(monthly, allowMissingColumns=True).repartition(S, I)
    out = cells.groupBy(S, I, T).agg(F.max(value).alias(value), *[F.max(c).alias(c) for c in features])
    return out.select(T, S, I, clip(F.coalesce(F.col(value), F.lit(0.0)), config.CLIP_LO, clip_hi).alias(value), *features)


def union_aligned(a: DataFrame, b: DataFrame, fill=None) -> DataFrame:
    """C4: union by name; a column missing on one side becomes NULL (or fill)."""
    out = a.unionByName(b, allowMissingColumns=True)
    if fill is not None:
        from unitcast.operators.clean import fill_numeric
        out = fill_numeric(out, fill)
    return out


def add_lags(df: DataFrame, c: str, lags, keys=PAIR, time: str = T,
             name: str | None = None) -> DataFrame:
    """Value of ``c`` at ``time - k`` for the same key (NULL if the key
    has no row that month).  All lags share one exchange and one sort."""
    w = pair_window(keys, time)
    name = name or c
    return df.select("*", *[F.max(c).over(w.rangeBetween(-k, -k)).alias(f"{name}_lag_{k}")
                            for k in lags])


def month_mean_lag(panel: DataFrame, value: str = "item_cnt_month",
                   name: str = "date_avg_item_cnt") -> DataFrame:
    """month mean of ``value`` (E5) lagged one month through the pair."""
    means, _ = checked_broadcast(panel.groupBy(T).agg(F.avg(value).alias(name)))
    out = panel.join(means, T, "left")
    return add_lags(out, name, [1]).drop(name)


def month_item_price_stats(sales: DataFrame, price: str = "item_price") -> DataFrame:
    """(month, item, _s, _n): exact decimal price sum and count."""
    return sales.groupBy(T, I).agg(F.sum(F.col(price).cast(DEC)).alias("_s"), F.count(price).alias("_n"))


def item_prices(stats: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (month, item, _s, _n): ``(item, _item_avg)`` and ``(month, item,
    _mi_avg, _item_avg)``, the mean prices that ``price_trend`` reads."""
    mi = materialize(stats.select(T, I, "_s", "_n"))
    item = mi.groupBy(I).agg((F.sum("_s").cast("double") / F.nullif(F.sum("_n"), F.lit(0))).alias("_item_avg"))
    month_item = mi.select(T, I, (F.col("_s").cast("double") / F.nullif(F.col("_n"), F.lit(0))).alias("_mi_avg"))
    return item, month_item.join(item, I)


def price_trend(panel: DataFrame, sales: DataFrame | None = None, lags=config.PRICE_LAGS,
                mode: str = "reference", price: str = "item_price",
                name: str = "delta_price_lag", month_item_stats: DataFrame | None = None) -> DataFrame:
    """Relative change of lagged month-item mean price against the
    item's overall mean price; first usable lag picked per ``mode``.

    Means come from exact decimal (sum, count) per month-item, taken from
    ``month_item_stats`` when given (e.g. rolled up from a stored
    month-shop-item table, so the sales are not scanned again) or from
    ``sales``; the item mean is the sum of sums over the sum of counts, which
    is exact and therefore equal to a direct mean.  A panel that already
    carries ``_item_avg`` and ``_mi_avg`` (``item_prices`` attached before the
    month product) is not joined at all."""
    if {"_item_avg", "_mi_avg"} <= set(panel.columns):
        return _trend(panel, lags, mode, name)
    stats = month_item_stats if month_item_stats is not None else month_item_price_stats(sales, price)
    mi = materialize(stats.select(T, I, "_s", "_n"))
    item_mean, _ = checked_broadcast(mi.groupBy(I).agg(
        (F.sum("_s").cast("double") / F.nullif(F.sum("_n"), F.lit(0))).alias("_item_avg")))
    month_item, _ = checked_broadcast(mi.select(
        T, I, (F.col("_s").cast("double") / F.nullif(F.col("_n"), F.lit(0))).alias("_mi_avg")),
        materialized=True)
    return _trend(panel.join(item_mean, I, "left").join(month_item, [T, I], "left"), lags, mode, name)


def _trend(panel: DataFrame, lags, mode: str, name: str) -> DataFrame:
    out = add_lags(panel, "_mi_avg", lags)
    # an item whose mean price is 0 has no relative change: missing, so its trend is 0
    deltas = [F.try_divide(F.col(f"_mi_avg_lag_{k}") - F.col("_item_avg"), F.col("_item_avg")) for k in lags]
    out = out.withColumn(name, F.coalesce(first_truthy(deltas, mode), F.lit(0.0)))
    return out.drop("_item_avg", "_mi_avg", *[f"_mi_avg_lag_{k}" for k in lags])


def pair_recency(panel: DataFrame, value: str = "item_cnt_month",
                 name: str = "item_shop_last_sale") -> DataFrame:
    """months since the pair's previous panel row, once a non-zero month
    has been passed; -1 before and on that first non-zero row."""
    w = pair_window()
    seen = F.max((F.col(value) != 0).cast("int")).over(
        w.rowsBetween(Window.unboundedPreceding, -1))
    gap = F.col(T) - F.lag(T, 1).over(w)
    return panel.withColumn(name, F.when(seen == 1, gap).otherwise(F.lit(-1)).cast("int"))


def item_recency(panel: DataFrame, value: str = "item_cnt_month", all_rows: bool = False,
                 name: str = "item_last_sale", first_rows: DataFrame | None = None) -> DataFrame:
    """months since the item's previous month in the panel, once the item
    has had a non-zero row in an earlier month.  Only the first row of the
    item in a month (lowest shop) gets it unless ``all_rows``.  For months in
    which rows have another order (the request month: file order), the first
    shop comes from ``first_rows`` (month, item, shop).

    Aggregated to (item, month) before the window, so the window input is
    one row per item-month and a hot item cannot swamp a task.
    """
    im = panel.groupBy(I, T).agg(F.min(S).alias("_first_shop"),
                                 F.max((F.col(value) != 0).cast("int")).alias("_nz"))
    w = Window.partitionBy(I).orderBy(T)
    seen = F.max("_nz").over(w.rowsBetween(Window.unboundedPreceding, -1))
    im = im.withColumn("_gap", F.when(seen == 1, F.col(T) - F.lag(T, 1).over(w))).drop("_nz")
    if first_rows is not None:
        given = first_rows.select(T, I, F.col(S).alias("_given"))
        im = (im.join(given, [T, I], "left")
              .withColumn("_first_shop", F.coalesce("_given", "_first_shop")).drop("_given"))
    im, _ = checked_broadcast(im)
    out = panel.join(im, [I, T], "left")
    take = F.col("_gap").isNotNull() & (F.lit(all_rows) | (F.col(S) == F.col("_first_shop")))
    return (out.withColumn(name, F.when(take, F.col("_gap")).otherwise(F.lit(-1)).cast("int"))
            .drop("_gap", "_first_shop"))


def previous_month_units(monthly: DataFrame, month: int, value: str = "item_cnt_month",
                         name: str = "item_cnt_prev_month") -> DataFrame:
    """F8: one fixed month's units per pair (to be joined to every row)."""
    return monthly.filter(F.col(T) == month).select(S, I, F.col(value).alias(name))


def lag_matrix(monthly: DataFrame, anchors, n_lags: int = config.REGRESSION_LAGS,
               value: str = "item_cnt_month", prefix: str = "lag_") -> DataFrame:
    """Per pair and anchor month, units 0..n_lags months before the
    anchor (0 if absent).  Every pair with any history row gets a row per
    anchor; columns are named by months-ago, not by position.  Sales are summed
    once per pair, one column per month that an anchor looks at, before the
    anchors multiply the (summed) rows."""
    anchors = list(anchors)
    months = sorted({x - k for x in anchors for k in range(n_lags + 1)})
    per = monthly.groupBy(S, I).agg(*[F.coalesce(F.sum(F.when(F.col(T) == m, F.col(value))), F.lit(0.0)).alias(f"_m{m}") for m in months])
    rows = F.array(*[F.struct(F.lit(x).alias("anchor"), *[F.col(f"_m{x - k}").alias(f"{prefix}{k}") for k in range(n_lags + 1)])
                     for x in anchors])
    return per.select(S, I, F.explode(rows).alias("_a")).select("_a.anchor", S, I, *[f"_a.{prefix}{k}" for k in range(n_lags + 1)])


def first_month(df: DataFrame) -> int | None:
    """The earliest month of the data (one scalar); None without rows."""
    return df.agg(F.min(T)).first()[0]
