"""Phase 5-6 queries: splits, metrics, cold-start fill, Spark ML models, sinks.

Flat-table model queries train on all observed shop x item months (grain A),
the frame that ``flat_model_frame`` checks, so fit time grows with the data.
Panel and month-matrix models train on grain B (nation x category), where the
dense panel is bounded by shops x items x months.  Their outputs are checked by
row count (no SQL oracle for fitted models); metrics, fills and sinks use a
deterministic stand-in prediction (the pair's mean monthly units) and are
checked against SQL.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from unitcast import config
from unitcast.config import scratch_path
from unitcast.functions.columns import rnd
from unitcast.operators import aggregate as agg
from unitcast.operators import clean, encode, models, panel
from unitcast.operators.fallback import cold_start_fill
from unitcast.operators.joins import materialize
from unitcast.plans import pipelines
from unitcast.plans.basic import clipped_monthly_sql, monthly
from unitcast.plans.panelq import PANEL_CTES, clipped_history, full_panel
from unitcast.plans.registry import query
from unitcast.plans.sqlparts import H, TM, exact_sum as sexact_sum, rnd as srnd, share_sql, sql
from unitcast.sources import files, tpch

LABEL = "item_cnt_month"
MODEL_CLIP = (config.CLIP_LO, config.CLIP_HI)



# ---- H1 ---------------------------------------------------------------------

@query("temporal_split_counts", sql(["sales_b", "request_b"], f"""SELECT split, count(*) AS n_rows FROM (
  SELECT CASE WHEN date_block_num < {H} THEN 'train' WHEN date_block_num = {H} THEN 'holdout'
              ELSE 'request' END AS split FROM pan WHERE date_block_num <= {TM}) GROUP BY split""",
                                    PANEL_CTES))
def q_temporal_split_counts(spark, sf_dir):
    """H1: rows in the train / holdout / request splits of the panel."""
    p = full_panel(spark, sf_dir)
    split = (F.when(F.col("date_block_num") < H, "train")
              .when(F.col("date_block_num") == H, "holdout").otherwise("request"))
    return (p.filter(F.col("date_block_num") <= TM).groupBy(split.alias("split"))
             .agg(F.count(F.lit(1)).alias("n_rows")))


# ---- stand-in prediction: pair mean over the clipped history -----------------

def pair_mean_pred(spark, sf_dir):
    return agg.mean_by(clipped_history(spark, sf_dir), ["shop_id", "item_id"], LABEL, "pred")


PRED_CTES = [clipped_monthly_sql(),
             "pr AS (SELECT shop_id, item_id, avg(item_cnt_month) AS pred FROM cm GROUP BY shop_id, item_id)"]

COLD_SQL_CTES = PRED_CTES + [
    f"ss AS ({share_sql('pr', 'shop_id', 'pred', 'shop_idx')})",
    f"si AS ({share_sql('pr', 'item_id', 'pred', 'item_idx')})",
    """j AS (SELECT r.ID, p.pred, ss.shop_idx, si.item_idx FROM request r
  LEFT JOIN pr p ON r.shop_id = p.shop_id AND r.item_id = p.item_id
  LEFT JOIN ss ON r.shop_id = ss.shop_id LEFT JOIN si ON r.item_id = si.item_id)""",
    f"""cold AS (SELECT ID, CASE WHEN x IS NULL THEN NULL
    ELSE least(greatest(x, {config.CLIP_LO}), {config.CLIP_HI}) END AS item_cnt_month
  FROM (SELECT ID, coalesce(pred, v * shop_idx * item_idx * {config.COLD_START_FACTOR},
                            v * shop_idx * {config.COLD_START_FACTOR}) AS x
        FROM j CROSS JOIN (SELECT avg(pred) AS v FROM j)))""",
]


def cold_fill_standin(spark, sf_dir):
    return cold_start_fill(tpch.request(spark, sf_dir), pair_mean_pred(spark, sf_dir))


@query("cold_start_fill", sql(["monthly", "request"], f"SELECT ID, {srnd('item_cnt_month', 6)} AS item_cnt_month FROM cold",
                              COLD_SQL_CTES))
def q_cold_start_fill(spark, sf_dir):
    """H11 + E10: request rows filled by pair, then shop x item, then shop index."""
    return cold_fill_standin(spark, sf_dir).withColumn(LABEL, rnd(LABEL, 6))


@query("output_means", sql(["monthly", "request"], f"""SELECT avg(ID) AS mean_ID,
  {srnd('avg(item_cnt_month)', 6)} AS mean_item_cnt_month FROM cold""", COLD_SQL_CTES))
def q_output_means(spark, sf_dir):
    """Mean of every output column of the filled predictions."""
    out = agg.output_means(cold_fill_standin(spark, sf_dir))
    return out.withColumn("mean_item_cnt_month", rnd("mean_item_cnt_month", 6))


EVAL_CTES = [clipped_monthly_sql(),
             "pr AS (SELECT shop_id, item_id, avg(item_cnt_month) AS pred FROM cm GROUP BY shop_id, item_id)",
             f"""ev AS (SELECT c.item_cnt_month AS y, p.pred FROM cm c JOIN pr p
  ON c.shop_id = p.shop_id AND c.item_id = p.item_id WHERE c.date_block_num = {H})"""]


def _eval_frame(spark, sf_dir):
    c = clipped_history(spark, sf_dir)
    return (c.filter(F.col("date_block_num") == H).join(pair_mean_pred(spark, sf_dir), ["shop_id", "item_id"])
             .select(F.col(LABEL).alias("y"), "pred"))


@query("rmse", sql(["monthly"], f"""SELECT {srnd(f"sqrt({sexact_sum('(y - pred) * (y - pred)')} / count(*))", 6)}
  AS rmse FROM ev""", EVAL_CTES))
def q_rmse(spark, sf_dir):
    """Holdout-month RMSE of the stand-in prediction."""
    return agg.rmse(_eval_frame(spark, sf_dir), "y", "pred").select(rnd("rmse", 6).alias("rmse"))


@query("r2_percent", sql(["monthly"], f"""SELECT {srnd(f"(1 - {sexact_sum('(y - pred) * (y - pred)')} / "
                                                      f"{sexact_sum('(y - mu) * (y - mu)')}) * 100", 2)} AS r2_percent
FROM ev CROSS JOIN (SELECT avg(y) AS mu FROM ev)""", EVAL_CTES))
def q_r2_percent(spark, sf_dir):
    """R^2 x 100 of the stand-in prediction on the holdout month."""
    return agg.r2_percent(_eval_frame(spark, sf_dir), "y", "pred")


# ---- A4, A5, A8 ---------------------------------------------------------------

@query("write_predictions", sql(["monthly", "request"], f"SELECT ID, {srnd('item_cnt_month', 6)} AS item_cnt_month FROM cold",
                                COLD_SQL_CTES))
def q_write_predictions(spark, sf_dir):
    """A4/A5: (ID, item_cnt_month) CSV sink (6 decimals), read back."""
    path = scratch_path(spark, f"predictions-{uuid.uuid4().hex}")
    files.write_predictions(cold_fill_standin(spark, sf_dir).withColumn(LABEL, rnd(LABEL, 6)), path)
    return files.read_predictions(spark, path)


@query("prediction_store", sql(["monthly", "request"], f"""SELECT 'holdout' AS split, c.shop_id, c.item_id,
  p.pred AS prediction FROM cm c JOIN pr p ON c.shop_id = p.shop_id AND c.item_id = p.item_id
  WHERE c.date_block_num = {H}
UNION ALL SELECT 'request', r.shop_id, r.item_id, p.pred FROM request r
  JOIN pr p ON r.shop_id = p.shop_id AND r.item_id = p.item_id""", PRED_CTES))
def q_prediction_store(spark, sf_dir):
    """Holdout and request predictions kept as (split, keys, prediction)."""
    pred = pair_mean_pred(spark, sf_dir).withColumnRenamed("pred", "prediction")
    hold = (clipped_history(spark, sf_dir).filter(F.col("date_block_num") == H)
            .select("shop_id", "item_id").join(pred, ["shop_id", "item_id"]))
    req = tpch.request(spark, sf_dir).select("shop_id", "item_id").join(pred, ["shop_id", "item_id"])
    path = scratch_path(spark, f"pred-store-{uuid.uuid4().hex}")
    files.save_predictions(hold, path, "holdout")
    files.save_predictions(req, path, "request")
    return spark.read.parquet(path).select("split", "shop_id", "item_id", "prediction")


# ---- H3 + H11: pivot-window regression (grain A) --------------------------------

LAGS9 = [f"lag_{k}" for k in range(1, config.REGRESSION_LAGS + 1)]


def _linreg(spark, sf_dir):
    lm = pipelines.regression_lags(tpch.sales(spark, sf_dir), H, TM)
    return lm, lm.filter(F.col("anchor") == H), pipelines.regression_model(lm, H)


@query("linreg_coefficients")
def q_linreg_coefficients(spark, sf_dir):
    """H3 + E16: intercept, coefficients and in-sample RMSE of months-ago 1..9 -> 0."""
    _, train, model = _linreg(spark, sf_dir)
    lr = model.stages[-1]
    fitted = model.transform(train)
    rmse = fitted.agg(F.sqrt(F.avg(F.pow(F.col("lag_0") - F.col("prediction"), 2)))).first()[0]
    rows = [("intercept", float(lr.intercept))] + list(zip(LAGS9, map(float, lr.coefficients))) + [("rmse", rmse)]
    return spark.createDataFrame(rows, "term string, value double")


@query("linreg_predictions")
def q_linreg_predictions(spark, sf_dir):
    """H3 + H9 + H11: scoring-anchor predictions, cold-start fill, clip."""
    return pipelines.regression_predictions(tpch.sales(spark, sf_dir), tpch.request(spark, sf_dir), H, TM)


# ---- flat monthly table + scoring frame (grain A) ---------------------------------

_FLAT: dict = {}


def _content(spark, sf_dir) -> tuple:
    """Session, folder and content of the tables that frames kept per session derive from."""
    return (spark.sparkContext.applicationId, sf_dir, tpch.fingerprint(spark, sf_dir, *tpch.MODEL_TABLES))


def flat_tables(spark, sf_dir, with_text=False):
    """Flat history and scoring frame (checkpointed once per session)."""
    key = (*_content(spark, sf_dir), with_text)
    if key not in _FLAT:
        _FLAT[key] = _flat_tables(spark, sf_dir, with_text)
    return _FLAT[key]


def _flat_tables(spark, sf_dir, with_text=False):
    return pipelines.flat_model_tables(
        tpch.sales(spark, sf_dir), tpch.request(spark, sf_dir), tpch.items(spark, sf_dir),
        tpch.categories(spark, sf_dir), tpch.shops(spark, sf_dir), H, TM, with_text=with_text)


_FORESTS: dict = {}


def _forest(spark, sf_dir, with_text=False):
    """Flat tables and the fitted forest, shared by the forest queries of one
    session (the tables are checkpointed, so the model stays valid)."""
    key = (*_content(spark, sf_dir), with_text)
    if key not in _FORESTS:
        hist, req = flat_tables(spark, sf_dir, with_text=with_text)
        feats = models.feature_columns(hist, LABEL)
        _FORESTS[key] = (hist, req, feats, models.fit_forest(hist, feats, LABEL))
    return _FORESTS[key]


@query("forest_predictions")
def q_forest_predictions(spark, sf_dir):
    """H4 + H9: forest (25 trees, depth 15) on the whole flat table."""
    _, req, _, model = _forest(spark, sf_dir)
    return models.score(model, req, MODEL_CLIP).select("ID", LABEL)


@query("forest_importance")
def q_forest_importance(spark, sf_dir):
    """H5: feature importances of the forest, descending."""
    _, _, feats, model = _forest(spark, sf_dir)
    return spark.createDataFrame(models.importances(model, feats), "feature string, importance double")


@query("forest_top6_predictions")
def q_forest_top6_predictions(spark, sf_dir):
    """H5: forest refitted on the six most important features."""
    hist, req, feats, model = _forest(spark, sf_dir)
    top6 = [f for f, _ in models.importances(model, feats)[:6]]
    refit = models.fit_forest(hist, top6, LABEL)
    return models.score(refit, req, MODEL_CLIP).select("ID", LABEL)


@query("r2_forest")
def q_r2_forest(spark, sf_dir):
    """E17 on the forest: in-sample R^2 x 100."""
    hist, _, feats, model = _forest(spark, sf_dir)
    return agg.r2_percent(models.in_sample(model, hist, feats, LABEL), LABEL, "prediction")


@query("gbt_text_predictions")
def q_gbt_text_predictions(spark, sf_dir):
    """H6 + G1-G3: boosted trees on the flat table with name length, word
    count and 25 TF-IDF columns per name; log1p target, early stop on the
    holdout month, predictions inverted and clipped."""
    hist, req = flat_tables(spark, sf_dir, with_text=True)
    hist = hist.withColumn(LABEL, F.log1p(LABEL))
    feats = models.feature_columns(hist, LABEL)
    train, valid, _ = models.temporal_split(hist)
    model = models.fit_boosted(train, feats, LABEL, valid=valid, patience=models.PATIENCE, **models.BOOSTED_ES)
    return models.score(model, req, MODEL_CLIP, invert_log=True).select("ID", LABEL)


# ---- H6: boosted trees on the panel features (grain B) ----------------------------

_PANEL_FRAMES: dict = {}


def panel_model_frame(spark, sf_dir):
    """Panel model frame, checkpointed once per session."""
    key = _content(spark, sf_dir)
    if key not in _PANEL_FRAMES:
        _PANEL_FRAMES[key] = _panel_model_frame(spark, sf_dir)
    return _PANEL_FRAMES[key]


def _panel_model_frame(spark, sf_dir):
    return pipelines.panel_model_frame(
        tpch.sales_grain(spark, sf_dir, "B"), tpch.request(spark, sf_dir, "B"),
        tpch.items_grain(spark, sf_dir, "B"), tpch.categories(spark, sf_dir),
        tpch.shops_grain(spark, sf_dir, "B"), TM, H)


@query("gbt_es_predictions")
def q_gbt_es_predictions(spark, sf_dir):
    """H6 + H9: boosted trees (depth 8, rate 0.3, patience 5) on the panel
    features; train < holdout, early stop on the holdout month."""
    p = panel_model_frame(spark, sf_dir)
    feats = models.feature_columns(p, LABEL, drop_month=False)
    train, valid, test = models.temporal_split(p)
    model = models.fit_boosted(train, feats, LABEL, valid=valid, patience=models.PATIENCE, **models.BOOSTED_ES)
    pred = models.score(model, test).select("shop_id", "item_id", LABEL)
    return tpch.request(spark, sf_dir, "B").join(pred, ["shop_id", "item_id"], "left").select("ID", LABEL)


# ---- H7 / H8 / H10: boosted trees on the month matrix (grain B) ---------------------

def history_lags(monthly_rows, last=H):
    """Names of the months-ago features: as many as the data's months before ``last``."""
    first = panel.first_month(monthly_rows)
    return [f"lag_{k}" for k in range(1, max(0, last - (last if first is None else first)) + 1)]


def request_matrix(m, req, last=H, target=TM):
    """H10 + B20: request pairs x months-ago 1..n for the train anchor (label =
    holdout month) and the scoring anchor (target month); n reaches back to
    the first month of the monthly rows ``m``.  Returns the frame and its features."""
    m = m.filter(F.col("date_block_num") <= last)
    lags = history_lags(m, last)
    lm = panel.lag_matrix(m, [last, target], n_lags=len(lags))
    rows = req.withColumn("anchor", F.explode(F.array(F.lit(last), F.lit(target))))  # two anchors per row
    out = rows.join(lm, ["anchor", "shop_id", "item_id"], "left")
    return materialize(clean.fill_numeric(out, 0.0, ["lag_0"] + lags)), lags


@query("gbt_slow_predictions")
def q_gbt_slow_predictions(spark, sf_dir):
    """H7 + H10: slow-rate boosted trees (200 rounds, rate 0.03) on the
    request pairs' month matrix; the scoring anchor slides one month."""
    mx, lags = request_matrix(monthly(spark, sf_dir, "B"), tpch.request(spark, sf_dir, "B"))
    model = models.fit_boosted(mx.filter(F.col("anchor") == H), lags, "lag_0", **models.BOOSTED_SLOW)
    return models.score(model, mx.filter(F.col("anchor") == TM)).select("ID", LABEL)


@query("gbt_matrix_predictions")
def q_gbt_matrix_predictions(spark, sf_dir):
    """H8 + C1 + G7: de-duplicated, price-filtered sales pivoted per pair,
    category group encoded, depth-10 boosted trees (10 rounds)."""
    s = tpch.sales_grain(spark, sf_dir, "B").filter(F.col("date_block_num") <= H)
    s = clean.dedupe_keep_first(s, ["date", "date_block_num", "shop_id", "item_id", "item_cnt_day"],
                                ["order_key", "line_no"])
    s = clean.clean_outliers(s, price_gt=0.0, price_lt=300000.0)
    m = materialize(agg.monthly_sales(s))
    lags = history_lags(m)
    lm = panel.lag_matrix(m, [H, TM], n_lags=len(lags))
    cats = clean.category_groups(tpch.categories(spark, sf_dir))
    cats = encode.encode_apply(cats, "cats", encode.encode_fit(cats, c="cats"), out="cats_code")
    lm = lm.join(cats.select(F.col("item_category_id").alias("item_id"), "cats_code"), "item_id")
    lm = materialize(lm)
    feats = ["shop_id", "item_id", "cats_code"] + lags
    model = models.fit_boosted(lm.filter(F.col("anchor") == H), feats, "lag_0", **models.BOOSTED_MATRIX)
    req = tpch.request(spark, sf_dir, "B")
    test = req.join(lm.filter(F.col("anchor") == TM), ["shop_id", "item_id"], "left")
    test = clean.fill_numeric(test, 0.0, lags)
    test = test.withColumn("cats_code", F.coalesce("cats_code", F.lit(-1)))   # unknown pair: no code
    return models.score(model, test).select("ID", LABEL)


# ---- E14 + C4: shop x category heat map over history and request rows ------------

HEATMAP_SQL = sql(["monthly", "request", "items"], """SELECT shop_id, item_category_id, count(item_cnt_month) AS n
FROM (SELECT m.shop_id, i.item_category_id, m.item_cnt_month FROM monthly m
      LEFT JOIN items i ON m.item_id = i.item_id
      UNION ALL SELECT r.shop_id, i.item_category_id, CAST(0.0 AS DOUBLE) FROM request r
      LEFT JOIN items i ON r.item_id = i.item_id)
GROUP BY shop_id, item_category_id""")


@query("shop_category_heatmap", HEATMAP_SQL)
def q_shop_category_heatmap(spark, sf_dir):
    """E14 + C4: history and request rows stacked by name (the request side
    lacks the month columns), then non-null units counted per shop x
    category, in long form: the number of categories may grow with the data."""
    items = tpch.items(spark, sf_dir).select("item_id", "item_category_id")
    hist = monthly(spark, sf_dir).join(items, "item_id", "left")
    req = tpch.request(spark, sf_dir).join(items, "item_id", "left").withColumn(LABEL, F.lit(0.0))
    both = panel.union_aligned(hist, req.drop("ID"))
    return both.groupBy("shop_id", "item_category_id").agg(F.count(LABEL).alias("n"))


# ---- H11 degenerate variant -----------------------------------------------------

@query("cold_start_fill_flat", sql(["monthly", "request"], f"""SELECT ID, {srnd('x', 6)} AS item_cnt_month FROM (
  SELECT ID, CASE WHEN y IS NULL THEN NULL ELSE least(greatest(y, {config.CLIP_LO}), {config.CLIP_HI}) END AS x
  FROM (SELECT ID, coalesce(pred, v * {config.COLD_START_FACTOR}) AS y
        FROM j CROSS JOIN (SELECT avg(pred) AS v FROM j)))""", COLD_SQL_CTES))
def q_cold_start_fill_flat(spark, sf_dir):
    """H11 (text-regression variant): missing pairs get mean x factor."""
    out = cold_start_fill(tpch.request(spark, sf_dir), pair_mean_pred(spark, sf_dir), use_item_index=False)
    return out.withColumn(LABEL, rnd(LABEL, 6))


# ---- A7: model persisted and reloaded ---------------------------------------------

@query("linreg_model_roundtrip")
def q_linreg_model_roundtrip(spark, sf_dir):
    """A7 + H3: fitted pipeline saved with the ML writer, loaded, applied."""
    from pyspark.ml import PipelineModel
    lm, _, model = _linreg(spark, sf_dir)
    path = scratch_path(spark, f"model-{uuid.uuid4().hex}")
    files.save_model(model, path)
    loaded = PipelineModel.load(path)
    scoring = lm.filter(F.col("anchor") == TM)
    return models.score(loaded, scoring, clip_range=(config.CLIP_LO, config.CLIP_HI)).select(
        "shop_id", "item_id", LABEL)


# ---- remaining script pipelines: text forest, slow boosted on text and panel -------

@query("forest_text_predictions")
def q_forest_text_predictions(spark, sf_dir):
    """H4 + G1-G3: forest (25 trees, depth 15) on the flat table with name
    length, word count and TF-IDF columns."""
    _, req, _, model = _forest(spark, sf_dir, with_text=True)
    return models.score(model, req, MODEL_CLIP).select("ID", LABEL)


@query("forest_text_top6_predictions")
def q_forest_text_top6_predictions(spark, sf_dir):
    """H5 on the text forest: refit on its six most important features."""
    hist, req, feats, model = _forest(spark, sf_dir, with_text=True)
    top6 = [f for f, _ in models.importances(model, feats)[:6]]
    return models.score(models.fit_forest(hist, top6, LABEL), req, MODEL_CLIP).select("ID", LABEL)


@query("r2_forest_text")
def q_r2_forest_text(spark, sf_dir):
    """E17 on the text forest: in-sample R^2 x 100."""
    hist, _, feats, model = _forest(spark, sf_dir, with_text=True)
    return agg.r2_percent(models.in_sample(model, hist, feats, LABEL), LABEL, "prediction")


@query("gbt_slow_text_predictions")
def q_gbt_slow_text_predictions(spark, sf_dir):
    """H7 + G1-G3: slow-rate boosted trees (200 rounds, rate 0.03) on the flat
    table with text features; log1p target, inverted and clipped."""
    hist, req = flat_tables(spark, sf_dir, with_text=True)
    hist = hist.withColumn(LABEL, F.log1p(LABEL))
    feats = models.feature_columns(hist, LABEL)
    train, _, _ = models.temporal_split(hist)
    model = models.fit_boosted(train, feats, LABEL, **models.BOOSTED_SLOW)
    return models.score(model, req, MODEL_CLIP, invert_log=True).select("ID", LABEL)


@query("gbt_slow_panel_predictions")
def q_gbt_slow_panel_predictions(spark, sf_dir):
    """H7: slow-rate boosted trees on the panel features (train < holdout),
    request month scored and clipped."""
    p = panel_model_frame(spark, sf_dir)
    feats = models.feature_columns(p, LABEL, drop_month=False)
    train, _, test = models.temporal_split(p)
    model = models.fit_boosted(train, feats, LABEL, **models.BOOSTED_SLOW)
    pred = models.score(model, test).select("shop_id", "item_id", LABEL)
    return tpch.request(spark, sf_dir, "B").join(pred, ["shop_id", "item_id"], "left").select("ID", LABEL)
