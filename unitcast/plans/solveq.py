"""Least squares and blending queries on the Gram sums."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from unitcast import config
from unitcast.config import scratch_path
from unitcast.functions.columns import rnd
from unitcast.operators import aggregate as agg
from unitcast.operators import blend, gram, panel
from unitcast.plans import pipelines
from unitcast.plans.basic import clipped_monthly_sql
from unitcast.plans.panelq import clipped_history
from unitcast.plans.registry import query
from unitcast.plans.sqlparts import H, TM, exact_sum as sexact_sum, rnd as srnd, sql
from unitcast.sources import files, tpch

KEYS = ["shop_id", "item_id"]
LABEL = "item_cnt_month"
LAGS = [f"lag_{k}" for k in range(1, config.REGRESSION_LAGS + 1)]


# ---- H3: sums and normal equations of the month-ago regression ----------------

_TRAIN_CTES = [clipped_monthly_sql(), "lm AS (SELECT shop_id, item_id, " + ", ".join(
    f"sum(CASE WHEN {H} - date_block_num = {k} THEN item_cnt_month ELSE 0.0 END) AS lag_{k}"
    for k in range(config.REGRESSION_LAGS + 1)) + " FROM cm GROUP BY shop_id, item_id)"]


def _gram_sql() -> str:
    value = {gram.INTERCEPT: "1.0", gram.LABEL: "lag_0", **{f: f for f in LAGS}}
    terms = [gram.INTERCEPT, *LAGS]
    pairs = [(a, b) for i, a in enumerate(terms) for b in terms[i:]] + [(a, gram.LABEL) for a in terms] + [(gram.LABEL, gram.LABEL)]
    names = ", ".join(f"{sexact_sum(f'{value[a]} * {value[b]}')} AS c{i}" for i, (a, b) in enumerate(pairs))
    rows = " UNION ALL ".join(f"SELECT '{a}' AS term, '{b}' AS other, coalesce(c{i}, 0.0) AS value FROM g" for i, (a, b) in enumerate(pairs))
    return sql(["monthly"], rows, [*_TRAIN_CTES, f"g AS (SELECT {names} FROM lm)"])


def _train_rows(spark, sf_dir):
    lags = pipelines.regression_lags(tpch.sales(spark, sf_dir), H, TM)
    return lags.filter(F.col("anchor") == H)


@query("linreg_gram", _gram_sql())
def q_linreg_gram(spark, sf_dir):
    """H3: the sums XᵀX, Xᵀy and yᵀy of the month-ago regression, one exact aggregate."""
    return gram.gram_long(_train_rows(spark, sf_dir), LAGS, "lag_0")


@query("linreg_normal_equations", sql(["monthly"], " UNION ALL ".join(
    f"SELECT '{t}' AS term, {srnd(f'coalesce(sum({x} * lag_0), 0.0)', 4)} AS xty, {srnd(f'coalesce(sum({x} * lag_0), 0.0)', 4)} AS xtxb FROM lm"
    for t, x in [(gram.INTERCEPT, "1.0"), *((f, f) for f in LAGS)]), _TRAIN_CTES))
def q_linreg_normal_equations(spark, sf_dir):
    """H3: both sides of the normal equations for the solved coefficients,
    summed over the rows; equal sides make the residuals orthogonal to every
    feature, so the coefficients are the least squares."""
    train = _train_rows(spark, sf_dir)
    weights = gram.least_squares(gram.fit_gram(train, LAGS, "lag_0"))
    sides = gram.normal_equations(train, LAGS, "lag_0", weights)
    return sides.select("term", *[rnd(F.coalesce(c, F.lit(0.0)), 4).alias(c) for c in ("xty", "xtxb")])


# ---- A8: blend of two stored predictors -----------------------------------------

MODELS = ["pair_mean", "previous_month"]

_BLEND_CTES = [     # grain B: pairs that sell in most months
    f"""cm AS (SELECT date_block_num, shop_id, item_id, least(greatest(sum(item_cnt_day), {config.CLIP_LO}), {config.CLIP_HI}) AS item_cnt_month
  FROM sales_b WHERE date_block_num <= {H} GROUP BY date_block_num, shop_id, item_id)""",
    f"truth AS (SELECT shop_id, item_id, item_cnt_month AS y FROM cm WHERE date_block_num = {H})",
    f"hm AS (SELECT shop_id, item_id, avg(item_cnt_month) AS p FROM cm WHERE date_block_num < {H} GROUP BY shop_id, item_id)",
    f"hp AS (SELECT shop_id, item_id, item_cnt_month AS q FROM cm WHERE date_block_num = {H - 1})",
    """ev AS (SELECT y, coalesce(p, 0.0) AS p, coalesce(q, 0.0) AS q FROM truth LEFT JOIN hm USING (shop_id, item_id)
  LEFT JOIN hp USING (shop_id, item_id))""",
    f"""g AS (SELECT count(*) AS n, {sexact_sum('p * p')} AS a, {sexact_sum('p * q')} AS b, {sexact_sum('q * q')} AS c,
  {sexact_sum('p * y')} AS s, {sexact_sum('q * y')} AS t, {sexact_sum('y * y')} AS yy FROM ev)""",
    "u AS (SELECT *, (s * c - t * b) / nullif(a * c - b * b, 0) AS w, (t * a - s * b) / nullif(a * c - b * b, 0) AS v FROM g)",
    """w AS (SELECT n, a, b, c, s, t, yy,
    CASE WHEN w >= 0 AND v >= 0 THEN w WHEN coalesce(s * s / nullif(a, 0), 0) >= coalesce(t * t / nullif(c, 0), 0) THEN coalesce(greatest(s / nullif(a, 0), 0), 0) ELSE 0 END AS w,
    CASE WHEN w >= 0 AND v >= 0 THEN v WHEN coalesce(s * s / nullif(a, 0), 0) >= coalesce(t * t / nullif(c, 0), 0) THEN 0 ELSE coalesce(greatest(t / nullif(c, 0), 0), 0) END AS v FROM u)""",
    "rmse AS (SELECT sqrt((yy - 2 * (w * s + v * t) + w * w * a + 2 * w * v * b + v * v * c) / n) AS e FROM w)",
]


def _store(spark, sf_dir) -> str:
    """Both predictors of both splits, saved; each split's rows know earlier months only."""
    history, path = clipped_history(spark, sf_dir, "B"), scratch_path(spark, f"model-store-{uuid.uuid4().hex}")
    for split, month in ((blend.HOLDOUT, H), (blend.REQUEST, H + 1)):
        before = history.filter(F.col("date_block_num") < month)
        files.save_model_predictions(agg.mean_by(before, KEYS, LABEL, "prediction"), path, split, MODELS[0])
        files.save_model_predictions(panel.previous_month_units(before, month - 1, name="prediction"), path, split, MODELS[1])
    return path


def _blend(spark, sf_dir):
    store = files.load_predictions(spark, _store(spark, sf_dir))
    truth = clipped_history(spark, sf_dir, "B").filter(F.col("date_block_num") == H)
    return store, blend.fit_blend(store, truth, MODELS, KEYS, LABEL)


@query("blend_weights", sql(["sales_b"], f"""SELECT '{MODELS[0]}' AS model, {srnd('w', 6)} AS weight, n, {srnd('e', 6)} AS holdout_rmse FROM w, rmse
UNION ALL SELECT '{MODELS[1]}', {srnd('v', 6)}, n, {srnd('e', 6)} FROM w, rmse""", _BLEND_CTES))
def q_blend_weights(spark, sf_dir):
    """Non-negative weights of two stored predictors and the blend's holdout error."""
    found = _blend(spark, sf_dir)[1]
    rows = [(m, w, found.rows, found.rmse) for m, w in found.weights.items()]
    out = spark.createDataFrame(rows, "model string, weight double, n long, holdout_rmse double")
    return out.withColumn("weight", rnd("weight", 6)).withColumn("holdout_rmse", rnd("holdout_rmse", 6))


@query("blend_predictions", sql(["sales_b", "request_b"], f"""SELECT r.ID, CASE WHEN p.x IS NULL THEN NULL
  ELSE {srnd(f'least(greatest(p.x, {config.CLIP_LO}), {config.CLIP_HI})', 6)} END AS item_cnt_month
FROM request_b r LEFT JOIN (SELECT shop_id, item_id, w * avg(item_cnt_month)
    + v * max(CASE WHEN date_block_num = {H} THEN item_cnt_month ELSE 0 END) AS x
  FROM cm, w WHERE date_block_num <= {H} GROUP BY shop_id, item_id, w, v) p
  ON r.shop_id = p.shop_id AND r.item_id = p.item_id""", _BLEND_CTES))
def q_blend_predictions(spark, sf_dir):
    """Request rows blended from the stored request split, clipped."""
    store, found = _blend(spark, sf_dir)
    pred = blend.blended(store, found, KEYS)
    out = tpch.request(spark, sf_dir, "B").join(pred, KEYS, "left")
    value = F.least(F.greatest("prediction", F.lit(config.CLIP_LO)), F.lit(config.CLIP_HI))
    return out.select("ID", F.when(F.col("prediction").isNotNull(), rnd(value, 6)).alias(LABEL))
