"""Month-by-month queries: appended feature months, carried state, means as of each month."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from unitcast import config
from unitcast.config import scratch_path
from unitcast.operators import asof, state
from unitcast.operators.joins import materialize
from unitcast.plans.basic import monthly
from unitcast.plans.panelq import PANEL_CTES, full_panel
from unitcast.plans.registry import query
from unitcast.plans.sqlparts import H, TM, sql
from unitcast.plans import pipelines
from unitcast.sources import files, tpch

RECENCY = ["item_shop_last_sale", "item_last_sale"]


@query("as_of_means", sql(["sales", "monthly"], """SELECT m.date_block_num, m.shop_id, m.item_id, m.item_cnt_month,
  CAST(sum(CAST(m.item_cnt_month AS DECIMAL(28,10))) OVER p AS DOUBLE) / nullif(count(m.item_cnt_month) OVER p, 0) AS item_cnt_month_mean_as_of,
  max(m.item_cnt_month) OVER (PARTITION BY m.shop_id, m.item_id ORDER BY m.date_block_num RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS item_cnt_prev_month,
  i.x AS item_price_mean_as_of
FROM monthly m LEFT JOIN (
  SELECT date_block_num, item_id, CAST(sum(s) OVER w AS DOUBLE) / nullif(sum(n) OVER w, 0) AS x
  FROM (SELECT date_block_num, item_id, sum(CAST(item_price AS DECIMAL(28,10))) AS s, count(item_price) AS n FROM sales GROUP BY ALL)
  WINDOW w AS (PARTITION BY item_id ORDER BY date_block_num RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) i
  ON m.date_block_num = i.date_block_num AND m.item_id = i.item_id
WINDOW p AS (PARTITION BY m.shop_id, m.item_id ORDER BY m.date_block_num RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""))
def q_as_of_means(spark, sf_dir):
    """E4 + E6 + F8 as of each month: pair mean, item mean price and last
    month's units from earlier months only."""
    return asof.as_of_means(monthly(spark, sf_dir), tpch.sales(spark, sf_dir))


def _lag_sql(k: int) -> str:
    return f"max(CASE WHEN h.date_block_num = {TM - k} THEN h.item_cnt_month END) AS item_cnt_month_lag_{k}"


@query("state_features", sql(["sales_b", "request_b"], f"""SELECT r.date_block_num, r.shop_id, r.item_id, r.item_cnt_month,
  {", ".join(f"p.item_cnt_month_lag_{k}" for k in config.COUNT_LAGS)},
  CAST(CASE WHEN p.sold THEN {TM} - p.last ELSE -1 END AS INTEGER) AS item_shop_last_sale,
  CAST(CASE WHEN i.sold AND r.shop_id = f.first THEN {TM} - i.last ELSE -1 END AS INTEGER) AS item_last_sale
FROM (SELECT * FROM pan WHERE date_block_num = {TM}) r
LEFT JOIN (SELECT shop_id, item_id, {", ".join(_lag_sql(k) for k in config.COUNT_LAGS)},
             max(date_block_num) AS last, bool_or(item_cnt_month <> 0) AS sold
           FROM pan h WHERE date_block_num < {TM} GROUP BY shop_id, item_id) p ON r.shop_id = p.shop_id AND r.item_id = p.item_id
LEFT JOIN (SELECT item_id, max(date_block_num) AS last, bool_or(item_cnt_month <> 0) AS sold
           FROM pan WHERE date_block_num < {TM} GROUP BY item_id) i ON r.item_id = i.item_id
LEFT JOIN (SELECT item_id, arg_min(shop_id, ID) AS first FROM request_b GROUP BY item_id) f ON r.item_id = f.item_id""", PANEL_CTES))
def q_state_features(spark, sf_dir):
    """F1 + F6 + F7 from carried state: the state two months before the
    request is advanced by the holdout month and gives the request month's features."""
    p = full_panel(spark, sf_dir, materialized=True)
    held = p.filter(F.col("date_block_num") == H)
    pairs = state.advance_pairs(materialize(state.pair_state(p, H - 1)), held, H)
    items = state.advance_items(materialize(state.item_state(p, H - 1)), held, H)
    rows = p.filter(F.col("date_block_num") == TM)
    first = pipelines.request_order(tpch.request(spark, sf_dir, "B"), TM)
    return state.features(rows, pairs, items, TM, first_rows=first)


@query("feature_month_append", sql(["monthly"], "SELECT date_block_num, shop_id, item_id, item_cnt_month FROM monthly"))
def q_feature_month_append(spark, sf_dir):
    """A monthly table saved up to the holdout month, the target month
    appended as its own partition, and appended again to no effect."""
    m = materialize(monthly(spark, sf_dir))
    path = scratch_path(spark, f"months-{uuid.uuid4().hex}")
    files.save_features(m.filter(F.col("date_block_num") <= H), path)
    month = m.filter(F.col("date_block_num") == TM)
    files.append_month(month, path, TM)
    files.append_month(month, path, TM)
    return files.load_features(spark, path).select("date_block_num", "shop_id", "item_id", "item_cnt_month")
