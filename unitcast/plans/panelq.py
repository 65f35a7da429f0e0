"""Phase 4 queries: dense panel (grain B) and its lag / trend / recency
features, the flat monthly table's features (grain A) and the scoring frame."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from unitcast import config
from unitcast.functions.columns import exact_mean, rnd
from unitcast.operators import aggregate as agg
from unitcast.operators import clean, panel
from unitcast.plans import pipelines
from unitcast.plans.basic import monthly
from unitcast.plans.registry import query
from unitcast.plans.sqlparts import H, TM, exact_mean as sexact_mean, rnd as srnd, sql
from unitcast.sources import tpch

KEYS = ["date_block_num", "shop_id", "item_id"]
PANEL_PRICE_LT, PANEL_COUNT_LT = pipelines.PANEL_PRICE_LT, pipelines.PANEL_COUNT_LT


# ---- Spark side: the generic pipelines on test-table frames ---------------------

def panel_sales(spark, sf_dir, grain="B"):
    return pipelines.panel_sales(tpch.sales_grain(spark, sf_dir, grain), H)


def history_panel(spark, sf_dir, grain="B"):
    """Dense panel of the history months with the clipped target."""
    return pipelines.dense_history_panel(tpch.sales_grain(spark, sf_dir, grain), H)


def full_panel(spark, sf_dir, grain="B", materialized=False):
    """C4: history panel plus the request month (target 0)."""
    return pipelines.request_panel(tpch.sales_grain(spark, sf_dir, grain), tpch.request(spark, sf_dir, grain),
                                   TM, H, materialized=materialized)


def panel_features(spark, sf_dir, grain="B"):
    """The whole feature table of the panel pipeline."""
    return pipelines.panel_feature_table(tpch.sales_grain(spark, sf_dir, grain),
                                         tpch.request(spark, sf_dir, grain), TM, H)


# ---- SQL side ---------------------------------------------------------------

PANEL_CTES = [
    f"""ps AS (SELECT * FROM sales_b WHERE date_block_num <= {H}
  AND item_price < {PANEL_PRICE_LT} AND item_cnt_day < {PANEL_COUNT_LT})""",
    """mb AS (SELECT date_block_num, shop_id, item_id, sum(item_cnt_day) AS item_cnt_month FROM ps GROUP BY ALL)""",
    """grid AS (SELECT s.date_block_num, s.shop_id, i.item_id
  FROM (SELECT DISTINCT date_block_num, shop_id FROM mb) s
  JOIN (SELECT DISTINCT date_block_num, item_id FROM mb) i ON s.date_block_num = i.date_block_num)""",
    f"""dense AS (SELECT g.date_block_num, g.shop_id, g.item_id,
  least(greatest(coalesce(m.item_cnt_month, 0.0), {config.CLIP_LO}), {config.CLIP_HI}) AS item_cnt_month
  FROM grid g LEFT JOIN mb m ON g.date_block_num = m.date_block_num
   AND g.shop_id = m.shop_id AND g.item_id = m.item_id)""",
    f"""pan AS (SELECT * FROM dense
  UNION ALL SELECT CAST({TM} AS INTEGER), shop_id, item_id, 0.0 FROM request_b)""",
]

W = "PARTITION BY shop_id, item_id ORDER BY date_block_num"


def _lag(c: str, k: int, alias: str) -> str:
    return f"max({c}) OVER ({W} RANGE BETWEEN {k} PRECEDING AND {k} PRECEDING) AS {alias}"


def psql(body: str, extra: list[str] | None = None) -> str:
    return sql(["sales_b", "request_b"], body, PANEL_CTES + list(extra or []))


LAG_COLS = ",\n  ".join(_lag("item_cnt_month", k, f"item_cnt_month_lag_{k}") for k in config.COUNT_LAGS)

MEAN_LAG_CTE = """ml AS (SELECT p.*, max(a.m) OVER (PARTITION BY p.shop_id, p.item_id ORDER BY p.date_block_num
  RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS date_avg_item_cnt_lag_1
  FROM pan p JOIN (SELECT date_block_num, avg(item_cnt_month) AS m FROM pan GROUP BY date_block_num) a
  ON p.date_block_num = a.date_block_num)"""


def _trend_ctes(mode: str) -> list[str]:
    lags = config.PRICE_LAGS
    lag_cols = ",\n  ".join(_lag("mi", k, f"mi_{k}") for k in lags)
    deltas = {k: f"((mi_{k} - ia) / ia)" for k in lags}
    if mode == "reference":
        chain = " ".join(f"WHEN {deltas[k]} IS NULL THEN 0.0 WHEN {deltas[k]} <> 0 THEN {deltas[k]}" for k in lags)
        pick = f"CASE {chain} ELSE 0.0 END"
    else:
        pick = "coalesce(" + ", ".join(f"nullif({deltas[k]}, 0)" for k in lags) + ", 0.0)"
    return [
        f"""ia AS (SELECT item_id, {sexact_mean('item_price')} AS ia FROM ps GROUP BY item_id)""",
        f"""mi AS (SELECT date_block_num, item_id, {sexact_mean('item_price')} AS mi FROM ps GROUP BY ALL)""",
        """pj AS (SELECT p.*, a.ia, m.mi FROM pan p LEFT JOIN ia a ON p.item_id = a.item_id
  LEFT JOIN mi m ON p.date_block_num = m.date_block_num AND p.item_id = m.item_id)""",
        f"""pl AS (SELECT *, {lag_cols} FROM pj)""",
        f"""tr AS (SELECT date_block_num, shop_id, item_id, item_cnt_month,
  {srnd(pick, 6)} AS delta_price_lag FROM pl)""",
    ]


PAIR_RECENCY = f"""CAST(CASE WHEN max(CASE WHEN item_cnt_month <> 0 THEN 1 ELSE 0 END) OVER ({W}
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) = 1
  THEN date_block_num - lag(date_block_num) OVER ({W}) ELSE -1 END AS INTEGER)"""

ITEM_RECENCY_CTE = """im AS (SELECT item_id, date_block_num, first_shop,
  CASE WHEN max(nz) OVER (PARTITION BY item_id ORDER BY date_block_num
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) = 1
       THEN date_block_num - lag(date_block_num) OVER (PARTITION BY item_id ORDER BY date_block_num) END AS gap
  FROM (SELECT item_id, date_block_num, min(shop_id) AS first_shop,
               max(CASE WHEN item_cnt_month <> 0 THEN 1 ELSE 0 END) AS nz FROM pan GROUP BY ALL))"""


def _item_recency_expr(all_rows: bool) -> str:
    cond = "im.gap IS NOT NULL" + ("" if all_rows else " AND p.shop_id = im.first_shop")
    return f"CAST(CASE WHEN {cond} THEN im.gap ELSE -1 END AS INTEGER)"


# ---- queries ----------------------------------------------------------------

@query("dense_panel", psql("SELECT * FROM dense"))
def q_dense_panel(spark, sf_dir):
    """Month x shop x item panel with the clipped target (grain B)."""
    return history_panel(spark, sf_dir).select(*KEYS, "item_cnt_month")


@query("union_history_and_request", psql("SELECT * FROM pan"))
def q_union_history_and_request(spark, sf_dir):
    """C4: panel plus request month rows, missing columns filled."""
    return full_panel(spark, sf_dir)


@query("month_mean", psql("SELECT date_block_num, avg(item_cnt_month) AS date_avg_item_cnt FROM pan GROUP BY 1"))
def q_month_mean(spark, sf_dir):
    """E5: mean units per month over the dense panel."""
    return full_panel(spark, sf_dir).groupBy("date_block_num").agg(
        F.avg("item_cnt_month").alias("date_avg_item_cnt"))


@query("panel_lags", psql(f"SELECT *, {LAG_COLS} FROM pan"))
def q_panel_lags(spark, sf_dir):
    """units lagged 1, 2, 3, 6 and 12 months (by month value, not row)."""
    return panel.add_lags(full_panel(spark, sf_dir), "item_cnt_month", config.COUNT_LAGS)


@query("month_mean_lag1", psql("SELECT * FROM ml", [MEAN_LAG_CTE]))
def q_month_mean_lag1(spark, sf_dir):
    """month mean lagged one month, gated by the pair's presence."""
    return panel.month_mean_lag(full_panel(spark, sf_dir, materialized=True))


@query("price_lags", psql(
    "SELECT date_block_num, shop_id, item_id, item_cnt_month, ia AS item_avg_item_price, "
    + ", ".join(f"mi_{k} AS date_item_avg_item_price_lag_{k}" for k in config.PRICE_LAGS) + " FROM pl",
    _trend_ctes("reference")[:4]))
def q_price_lags(spark, sf_dir):
    """month-item mean price lagged 1..6 months through the pair."""
    s = panel_sales(spark, sf_dir)
    ia = s.groupBy("item_id").agg(exact_mean("item_price").alias("item_avg_item_price"))
    mi = s.groupBy("date_block_num", "item_id").agg(exact_mean("item_price").alias("date_item_avg_item_price"))
    p = full_panel(spark, sf_dir).join(ia, "item_id", "left").join(mi, ["date_block_num", "item_id"], "left")
    p = panel.add_lags(p, "date_item_avg_item_price", config.PRICE_LAGS)
    return p.drop("date_item_avg_item_price")


@query("price_trend", psql("SELECT * FROM tr", _trend_ctes("reference")))
def q_price_trend(spark, sf_dir):
    """first usable price trend, reference semantics (missing stops the scan)."""
    p = pipelines.price_trend_table(tpch.sales_grain(spark, sf_dir, "B"), tpch.request(spark, sf_dir, "B"),
                                    TM, H, mode="reference")
    return p.withColumn("delta_price_lag", rnd("delta_price_lag", 6))


@query("price_trend_first_valid", psql("SELECT * FROM tr", _trend_ctes("first_valid")))
def q_price_trend_first_valid(spark, sf_dir):
    """F5 variant: first non-missing, non-zero trend."""
    p = pipelines.price_trend_table(tpch.sales_grain(spark, sf_dir, "B"), tpch.request(spark, sf_dir, "B"),
                                    TM, H, mode="first_valid")
    return p.withColumn("delta_price_lag", rnd("delta_price_lag", 6))


@query("item_shop_recency", psql(f"SELECT *, {PAIR_RECENCY} AS item_shop_last_sale FROM pan"))
def q_item_shop_recency(spark, sf_dir):
    """months since the pair's previous panel row."""
    return panel.pair_recency(full_panel(spark, sf_dir))


@query("item_recency", psql(f"""SELECT p.*, {_item_recency_expr(False)} AS item_last_sale
FROM pan p LEFT JOIN im ON p.item_id = im.item_id AND p.date_block_num = im.date_block_num""",
                            [ITEM_RECENCY_CTE]))
def q_item_recency(spark, sf_dir):
    """months since the item's previous month, first row of the month only."""
    return panel.item_recency(full_panel(spark, sf_dir, materialized=True))


@query("item_recency_all_rows", psql(f"""SELECT p.*, {_item_recency_expr(True)} AS item_last_sale
FROM pan p LEFT JOIN im ON p.item_id = im.item_id AND p.date_block_num = im.date_block_num""",
                                     [ITEM_RECENCY_CTE]))
def q_item_recency_all_rows(spark, sf_dir):
    """F7 variant: every row of the item-month gets the gap."""
    return panel.item_recency(full_panel(spark, sf_dir, materialized=True), all_rows=True)


FEATURES_SQL = psql(f"""SELECT date_block_num, shop_id, item_id, item_cnt_month, {LAG_COLS},
  date_avg_item_cnt_lag_1, delta_price_lag, {PAIR_RECENCY} AS item_shop_last_sale,
  CAST(CASE WHEN gap IS NOT NULL AND shop_id = first_shop THEN gap ELSE -1 END AS INTEGER) AS item_last_sale
FROM (SELECT t.*, ml.date_avg_item_cnt_lag_1, im.gap, im.first_shop
      FROM tr t JOIN ml ON t.date_block_num = ml.date_block_num AND t.shop_id = ml.shop_id
                       AND t.item_id = ml.item_id
      LEFT JOIN im ON t.item_id = im.item_id AND t.date_block_num = im.date_block_num)""",
                    [MEAN_LAG_CTE, ITEM_RECENCY_CTE] + _trend_ctes("reference"))


@query("feature_table_roundtrip", FEATURES_SQL)
def q_feature_table_roundtrip(spark, sf_dir):
    """Feature table written partitioned by month to the shared
    checkpoint folder and read back (later splits prune by month)."""
    from unitcast.sources.files import load_features, save_features
    from unitcast.config import scratch_path
    path = scratch_path(spark, f"features-{uuid.uuid4().hex}")
    save_features(panel_features(spark, sf_dir), path)
    return load_features(spark, path)


# ---- flat monthly table (grain A) -------------------------------------------

FLAT_CTES = [f"""pm AS (SELECT shop_id, item_id, item_cnt_month AS item_cnt_prev_month
  FROM monthly WHERE date_block_num = {H})""",
             """mm AS (SELECT shop_id, item_id, avg(item_cnt_month) AS item_cnt_month_mean
  FROM monthly GROUP BY shop_id, item_id)"""]


def flat_history(spark, sf_dir):
    """Flat monthly table with pair mean (E4) and holdout-month units (F8)."""
    m = monthly(spark, sf_dir)
    mean = agg.mean_by(m, ["shop_id", "item_id"], "item_cnt_month", "item_cnt_month_mean")
    prev = panel.previous_month_units(m, H)
    out = m.join(mean, ["shop_id", "item_id"], "left").join(prev, ["shop_id", "item_id"], "left")
    return clean.fill_numeric(out, 0.0, ["item_cnt_prev_month"])


@query("prev_month_units", sql(["monthly"], f"""SELECT m.date_block_num, m.shop_id, m.item_id,
  m.item_cnt_month, {srnd('mm.item_cnt_month_mean', 6)} AS item_cnt_month_mean,
  coalesce(pm.item_cnt_prev_month, 0.0) AS item_cnt_prev_month
FROM monthly m LEFT JOIN mm ON m.shop_id = mm.shop_id AND m.item_id = mm.item_id
LEFT JOIN pm ON m.shop_id = pm.shop_id AND m.item_id = pm.item_id""", FLAT_CTES))
def q_prev_month_units(spark, sf_dir):
    """F8 + E4: the holdout month's units and the pair mean on every row."""
    f = flat_history(spark, sf_dir)
    return f.withColumn("item_cnt_month_mean", rnd("item_cnt_month_mean", 6)).select(
        "date_block_num", "shop_id", "item_id", "item_cnt_month", "item_cnt_month_mean", "item_cnt_prev_month")


def clipped_history(spark, sf_dir, grain="A"):
    return pipelines.clipped_monthly(tpch.sales_grain(spark, sf_dir, grain), H, pairs=grain == "A")


LAG_MATRIX_SQL = sql(["monthly"], f"""SELECT a.anchor, c.shop_id, c.item_id,
  {", ".join(f"sum(CASE WHEN a.anchor - c.date_block_num = {k} THEN c.item_cnt_month ELSE 0.0 END) AS lag_{k}"
             for k in range(config.REGRESSION_LAGS + 1))}
FROM (SELECT date_block_num, shop_id, item_id,
        least(greatest(item_cnt_month, {config.CLIP_LO}), {config.CLIP_HI}) AS item_cnt_month
      FROM monthly WHERE date_block_num <= {H}) c
CROSS JOIN (SELECT {H} AS anchor UNION ALL SELECT {TM}) a
GROUP BY a.anchor, c.shop_id, c.item_id""")


@query("lag_matrix", LAG_MATRIX_SQL)
def q_lag_matrix(spark, sf_dir):
    """Months-ago 0..9 per pair for the train anchor (holdout month)
    and the scoring anchor (target month)."""
    return panel.lag_matrix(clipped_history(spark, sf_dir), [H, TM])


SCORING_COLS = ["ID", "shop_id", "item_id", "date_block_num", "month", "year", "item_cnt_month_mean",
                "item_cnt_prev_month", "item_name", "item_category_id", "item_category_name", "shop_name",
                "item_cnt_month"]


def scoring_frame(spark, sf_dir):
    """Request rows with the history features, dimensions and constants."""
    m = monthly(spark, sf_dir)
    mean = agg.mean_by(m, ["shop_id", "item_id"], "item_cnt_month", "item_cnt_month_mean")
    prev = panel.previous_month_units(m, H)
    r = (tpch.request(spark, sf_dir)
         .withColumn("date_block_num", F.lit(TM).cast("int"))
         .withColumn("month", F.lit(TM % 12 + 1).cast("int"))
         .withColumn("year", F.lit(config.BASE_YEAR + TM // 12).cast("int")))
    r = (r.join(mean, ["shop_id", "item_id"], "left").join(prev, ["shop_id", "item_id"], "left")
          .join(tpch.items(spark, sf_dir), "item_id", "left")
          .join(tpch.categories(spark, sf_dir), "item_category_id", "left")
          .join(tpch.shops(spark, sf_dir), "shop_id", "left"))
    r = clean.fill_numeric(r, 0.0, ["item_cnt_month_mean", "item_cnt_prev_month"])
    return r.withColumn("item_cnt_month", F.lit(0.0))


@query("scoring_frame", sql(["monthly", "request", "items", "shops"], f"""SELECT r.ID, r.shop_id, r.item_id,
  CAST({TM} AS INTEGER) AS date_block_num, CAST({TM % 12 + 1} AS INTEGER) AS month,
  CAST({config.BASE_YEAR + TM // 12} AS INTEGER) AS year,
  {srnd('coalesce(mm.item_cnt_month_mean, 0.0)', 6)} AS item_cnt_month_mean,
  coalesce(pm.item_cnt_prev_month, 0.0) AS item_cnt_prev_month,
  i.item_name, i.item_category_id, c.item_category_name, s.shop_name, CAST(0.0 AS DOUBLE) AS item_cnt_month
FROM request r LEFT JOIN mm ON r.shop_id = mm.shop_id AND r.item_id = mm.item_id
LEFT JOIN pm ON r.shop_id = pm.shop_id AND r.item_id = pm.item_id
LEFT JOIN items i ON r.item_id = i.item_id
LEFT JOIN categories c ON i.item_category_id = c.item_category_id
LEFT JOIN shops s ON r.shop_id = s.shop_id""", FLAT_CTES))
def q_scoring_frame(spark, sf_dir):
    """H12 + B9: request rows with pair mean, holdout units, names and constants."""
    f = scoring_frame(spark, sf_dir)
    return f.withColumn("item_cnt_month_mean", rnd("item_cnt_month_mean", 6)).select(*SCORING_COLS)
