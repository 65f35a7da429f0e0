"""End-to-end pipelines over sales-model DataFrames from any source.

Inputs follow the sales data model (``sources.files.read_csv_tables`` loads
it from the original CSV files; ``sources.tpch`` derives it from the test
tables):

* sales    (date, date_block_num, shop_id, item_id, item_price, item_cnt_day)
* request  (ID, shop_id, item_id)

The registered queries call these functions with test-table frames, so the
oracle checks cover them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from unitcast import config
from unitcast.functions.columns import clip, rnd
from unitcast.operators import aggregate as agg
from unitcast.operators import clean, encode, models, panel, text
from unitcast.operators.fallback import cold_start_fill
from unitcast.operators.joins import materialize, materialize_bucketed

T, S, I = "date_block_num", "shop_id", "item_id"
KEYS = [T, S, I]
# The reference's outlier bounds for the panel pipeline.
PANEL_PRICE_LT, PANEL_COUNT_LT = 100000.0, 1001.0


def panel_sales(sales: DataFrame, holdout_month: int = config.HOLDOUT_MONTH) -> DataFrame:
    """History rows of the panel pipeline: months up to the holdout, outliers out."""
    s = sales.filter(F.col(T) <= holdout_month)
    return clean.clean_outliers(s, price_lt=PANEL_PRICE_LT, count_lt=PANEL_COUNT_LT)


def clean_inputs(sales: DataFrame, request: DataFrame, shop_remap: dict | None = None,
                 bad_price_lt: float = 0.0, like: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """The panel script's cleaning chain: outliers out (B4), prices below
    ``bad_price_lt`` replaced by the median price of the rows that equal
    ``like`` in the given columns (B6, B7), and duplicate shops merged in the
    sales and in the request table (B8)."""
    s = clean.clean_outliers(sales, price_lt=PANEL_PRICE_LT, count_lt=PANEL_COUNT_LT)
    group = s.filter(F.col("item_price") >= bad_price_lt)
    for column, value in (like or {}).items():
        group = group.filter(F.col(column) == value)
    middle = clean.exact_median(group, "item_price")
    if middle is not None:
        s = s.withColumn("item_price", F.when(F.col("item_price") < bad_price_lt, middle).otherwise(F.col("item_price")))
    if shop_remap:
        s, request = clean.remap_keys(s, shop_remap, S), clean.remap_keys(request, shop_remap, S)
    return s, request


def dense_history_panel(sales: DataFrame, holdout_month: int = config.HOLDOUT_MONTH) -> DataFrame:
    """Dense panel of the history months with the clipped target."""
    return panel.dense_panel(agg.monthly_sales(panel_sales(sales, holdout_month)))


DEC = panel.DEC


def panel_cells(sales: DataFrame, holdout_month: int = config.HOLDOUT_MONTH) -> DataFrame:
    """One scan of the history sales, stored: per (month, shop, item) the
    units (E2) and the exact price sum and count that the month-item and
    item mean prices (E6, E7) roll up from."""
    s = panel_sales(sales, holdout_month)
    return materialize(s.groupBy(T, S, I).agg(
        F.sum("item_cnt_day").alias("item_cnt_month"),
        F.sum(F.col("item_price").cast(DEC)).alias("_ps"), F.count("item_price").alias("_pn")))


def month_item_stats(cells: DataFrame) -> DataFrame:
    return cells.groupBy(T, I).agg(F.sum("_ps").alias("_s"), F.sum("_pn").alias("_n"))


def request_panel(sales: DataFrame, request: DataFrame, target_month: int = config.TARGET_MONTH,
                  holdout_month: int = config.HOLDOUT_MONTH, materialized: bool = False,
                  cells: DataFrame | None = None, with_prices: bool = False) -> DataFrame:
    """C4 + D4: history panel plus the request month (target 0).  Request keys
    enter the grid before its single (shop, item) exchange; ``materialized``
    stores it bucketed on the pair for plans that read it more than once.
    ``with_prices`` attaches the mean prices of F3-F5 to the month-item side
    before the product."""
    req = request.select(S, I).withColumn(T, F.lit(target_month).cast("int"))
    cells = cells if cells is not None else panel_cells(sales, holdout_month)
    prices = None
    if with_prices:
        item, prices = panel.item_prices(month_item_stats(cells))
        req = req.join(item, I, "left")
    p = panel.dense_panel(cells, extra_keys=req, monthly_stored=True, item_features=prices)
    p = p.select(*KEYS, "item_cnt_month", *(["_mi_avg", "_item_avg"] if with_prices else []))
    if materialized:
        return materialize_bucketed(p, [S, I], [S, I, T])
    return p


def request_order(request: DataFrame, target_month: int) -> DataFrame:
    """(month, item, shop): the shop of each item's first request row (lowest ID)."""
    return (request.groupBy(I).agg(F.min_by(S, "ID").alias(S))
            .withColumn(T, F.lit(target_month).cast("int")))


def panel_feature_table(sales: DataFrame, request: DataFrame, target_month: int = config.TARGET_MONTH,
                        holdout_month: int = config.HOLDOUT_MONTH) -> DataFrame:
    """The panel pipeline's feature table: lags 1/2/3/6/12 (F1), month-mean
    lag (F2), price trend (F3-F5), pair and item recency (F6, F7)."""
    cells = panel_cells(sales, holdout_month)          # the only scan of the sales
    p = request_panel(sales, request, target_month, holdout_month, materialized=True, cells=cells, with_prices=True)
    p = panel.add_lags(p, "item_cnt_month", config.COUNT_LAGS)
    p = panel.month_mean_lag(p)
    p = panel.price_trend(p)
    p = panel.pair_recency(p)
    p = panel.item_recency(p, first_rows=request_order(request, target_month))
    return p.withColumn("delta_price_lag", rnd("delta_price_lag", 6))


def price_trend_table(sales: DataFrame, request: DataFrame, target_month: int = config.TARGET_MONTH,
                      holdout_month: int = config.HOLDOUT_MONTH, mode: str = "reference") -> DataFrame:
    """F3-F5 on the request panel, from a single scan of the sales."""
    cells = panel_cells(sales, holdout_month)
    p = request_panel(sales, request, target_month, holdout_month, cells=cells, with_prices=True)
    return panel.price_trend(p, mode=mode)


def clipped_monthly(sales: DataFrame, holdout_month: int = config.HOLDOUT_MONTH, pairs: bool = True) -> DataFrame:
    """E2 + B11: monthly units up to the holdout month, clipped to [0, 20];
    ``pairs``: shop x item sales, of few rows per pair."""
    m = (agg.monthly_of_pairs if pairs else agg.monthly_sales)(sales).filter(F.col(T) <= holdout_month)
    return m.withColumn("item_cnt_month", clip("item_cnt_month"))


def regression_lags(sales: DataFrame, holdout_month: int = config.HOLDOUT_MONTH,
                    target_month: int = config.TARGET_MONTH,
                    n_lags: int = config.REGRESSION_LAGS) -> DataFrame:
    """Months-ago matrix for the train and scoring anchors (stored)."""
    return materialize(panel.lag_matrix(clipped_monthly(sales, holdout_month),
                                        [holdout_month, target_month], n_lags))


def regression_model(lags: DataFrame, holdout_month: int = config.HOLDOUT_MONTH,
                     n_lags: int = config.REGRESSION_LAGS):
    """H3: least squares of month-ago 0 on months-ago 1..n at the train anchor."""
    feats = [f"lag_{k}" for k in range(1, n_lags + 1)]
    return models.fit_linear(lags.filter(F.col("anchor") == holdout_month), feats, "lag_0")


def regression_predictions(sales: DataFrame, request: DataFrame,
                           holdout_month: int = config.HOLDOUT_MONTH,
                           target_month: int = config.TARGET_MONTH,
                           n_lags: int = config.REGRESSION_LAGS) -> DataFrame:
    """H3 + H9 + H11: fitted scoring-anchor predictions per pair, then the
    cold-start fill and clip for every request row -> (ID, item_cnt_month)."""
    lags = regression_lags(sales, holdout_month, target_month, n_lags)
    model = regression_model(lags, holdout_month, n_lags)
    preds = models.score(model, lags.filter(F.col("anchor") == target_month), clip_range=None,
                         out="pred").select(S, I, "pred")
    return cold_start_fill(request, preds)


# ---- model feature frames ----------------------------------------------------------

NAME_COLS = ["shop_name", "item_category_name", "item_name"]
LABEL = "item_cnt_month"
CATEGORY = "item_category_id"


#: Lookup tables of the flat frames: key and name column.
DIMENSIONS = {"items": (I, "item_name"), "categories": (CATEGORY, "item_category_name"), "shops": (S, "shop_name")}


def with_text_features(frame: DataFrame, key: str, name: str) -> DataFrame:
    """A lookup table with name length, word count and 25 TF-IDF columns."""
    stats = text.text_stats(frame.select(key, name), name, name).drop(name)
    return frame.join(stats, key, "left").join(text.tfidf_wide(text.tfidf(frame, key, name), key, name), key, "left")


def seen_lookups(dims: dict[str, DataFrame], *rows: DataFrame) -> dict[str, DataFrame]:
    """The lookup rows that some row of ``rows`` meets: their names are the
    encoder domains (C5), found without attaching a name to any row."""
    def met(frame, key, sides):
        keys = [r.select(key) for r in sides]
        return frame.join(reduce(DataFrame.union, keys).distinct(), key, "left_semi")
    out = {name: met(dims[name], DIMENSIONS[name][0], rows) for name in ("items", "shops")}
    out["categories"] = met(dims["categories"], CATEGORY, [out["items"]])
    return out


def coded_lookups(dims: dict[str, DataFrame], codes: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The lookup tables with codes for names, so that rows meet numbers
    and no string travels with them."""
    return {name: encode.encode_apply(dims[name], c, codes[c]) for name, (_, c) in DIMENSIONS.items()}


def with_lookups(df: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Rows with their (coded) lookups; a row that a lookup lacks gets code -1,
    other numeric NULLs 0 (B12)."""
    for name in ("items", "categories", "shops"):
        df = df.join(dims[name], DIMENSIONS[name][0], "left")
    return clean.fill_numeric(df.na.fill(-1, subset=NAME_COLS), 0.0)


def _frame_order(df: DataFrame, dims: dict[str, DataFrame]) -> list[str]:
    """Keys first, then the row's own columns, the names, and the text features by lookup."""
    keys = [S, CATEGORY, I]
    names = [DIMENSIONS[name][1] for name in ("items", "categories", "shops")]
    extra = [c for name in ("items", "categories", "shops") for c in dims[name].columns if c not in (*keys, *names)]
    return keys + [c for c in df.columns if c not in (*keys, *names, *extra)] + names + extra


def flat_model_tables(sales: DataFrame, request: DataFrame, items: DataFrame, categories: DataFrame,
                      shops: DataFrame, holdout_month: int = config.HOLDOUT_MONTH,
                      target_month: int = config.TARGET_MONTH, with_text: bool = False,
                      clip_hi: float = config.CLIP_HI, tasks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Flat monthly history (observed pairs) and the request scoring frame:
    calendar parts (E3, G9), pair mean (E4), holdout-month units (F8),
    dimension names label-encoded on history + request (G6, C5), constants
    for the request month (B9, H12), numeric NULL -> 0 (B12).  Names are
    encoded in their lookup tables, so rows only ever carry numbers.  Both frames
    are stored; the history target is clipped to [0, clip_hi].  The request
    month's year continues the calendar of the sales themselves."""
    s = sales.filter(F.col(T) <= holdout_month)
    m = materialize(agg.sum_all_but(s.select(T, S, I, F.month("date").alias("month"), F.year("date").alias("year"),
                                             "item_cnt_day"), "item_cnt_day", LABEL))
    mean = materialize(agg.mean_by(m, [S, I], LABEL, "item_cnt_month_mean"))
    prev = panel.previous_month_units(m, holdout_month)
    dims = {"items": items, "categories": categories, "shops": shops}
    seen = seen_lookups(dims, m, request)
    codes = {c: encode.encode_fit(seen[name], c=c) for name, (_, c) in DIMENSIONS.items()}
    if with_text:
        dims = {name: with_text_features(frame, *DIMENSIONS[name]) for name, frame in dims.items()}
    dims = {name: materialize(frame) for name, frame in coded_lookups(dims, codes).items()}
    base_year = s.agg(F.min(F.year("date") - F.floor(F.col(T) / 12))).first()[0]
    req = (request.withColumn("month", F.lit(target_month % 12 + 1).cast("int"))
           .withColumn("year", F.lit(None if base_year is None else base_year + target_month // 12).cast("int"))
           .withColumn(T, F.lit(target_month).cast("int")))

    def framed(rows):
        out = with_lookups(rows.join(mean, [S, I], "left").join(prev, [S, I], "left"), dims)
        return out.select(_frame_order(out, dims))

    hist = framed(m).withColumn(LABEL, clip(LABEL, config.CLIP_LO, clip_hi))
    return materialize(hist), materialize(framed(req).withColumn(LABEL, F.lit(0.0)))


def panel_model_frame(sales: DataFrame, request: DataFrame, items: DataFrame, categories: DataFrame,
                      shops: DataFrame, target_month: int = config.TARGET_MONTH,
                      holdout_month: int = config.HOLDOUT_MONTH) -> DataFrame:
    """Panel feature table plus shop city code (G4), item category and its
    type / subtype codes (G5), label-encoded (G6); stored for model fitting."""
    p = panel_feature_table(sales, request, target_month, holdout_month)
    sh = text.shop_city(shops)
    sh = encode.encode_apply(sh, "city", encode.encode_fit(sh, c="city"), out="city_code")
    ca = text.category_type_subtype(categories)
    ca = encode.encode_apply(ca, "type", encode.encode_fit(ca, c="type"), out="type_code")
    ca = encode.encode_apply(ca, "subtype", encode.encode_fit(ca, c="subtype"), out="subtype_code")
    it = (items.select(I, "item_category_id")
          .join(ca.select("item_category_id", "type_code", "subtype_code"), "item_category_id", "left"))
    p = p.join(sh.select(S, "city_code"), S, "left").join(it, I, "left")
    return materialize(clean.fill_numeric(p, 0.0))
