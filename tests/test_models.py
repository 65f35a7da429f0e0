"""Model operators on small data: determinism, shapes, clipping."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from unitcast.operators import models


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(3)
    rows = []
    for m in range(12):
        for s in range(6):
            for i in range(8):
                x1, x2 = float(rng.integers(0, 10)), float(rng.integers(0, 5))
                rows.append((m, s, i, x1, x2, float(max(0.0, 2 * x1 - x2 + rng.normal()))))
    return spark.createDataFrame(rows, "date_block_num int, shop_id long, item_id long, x1 double, "
                                       "x2 double, item_cnt_month double")


def test_feature_columns_drop_month_quirk(frame):
    df = frame.withColumn("month", F.lit(1))
    assert "month" not in models.feature_columns(df, "item_cnt_month")
    assert "month" in models.feature_columns(df, "item_cnt_month", drop_month=False)


def test_boosted_early_stop_deterministic(frame):
    train, valid, _ = models.temporal_split(frame, holdout=10, target=11)
    feats = ["x1", "x2", "shop_id", "item_id"]
    params = dict(maxDepth=3, stepSize=0.3, seed=42)
    a = models.fit_boosted(train, feats, "item_cnt_month", valid=valid, patience=2, max_rounds=8, **params)
    b = models.fit_boosted(train, feats, "item_cnt_month", valid=valid, patience=2, max_rounds=8, **params)
    pa = [r.item_cnt_month for r in models.score(a, valid).orderBy("shop_id", "item_id").collect()]
    pb = [r.item_cnt_month for r in models.score(b, valid).orderBy("shop_id", "item_id").collect()]
    assert pa == pb and all(0.0 <= p <= 20.0 for p in pa)
    assert len(a.stages[-1].trees) <= 8


def test_forest_and_linear_shapes(frame):
    feats = ["x1", "x2"]
    rf = models.fit_forest(frame, feats, "item_cnt_month", num_trees=3, max_depth=4)
    out = models.score(rf, frame, clip_range=(0.0, 5.0))
    assert out.count() == frame.count()
    assert out.agg(F.max("item_cnt_month")).first()[0] <= 5.0
    imp = models.importances(rf, feats)
    assert imp[0][0] == "x1"                         # the strong signal ranks first
    lr = models.fit_linear(frame, feats, "item_cnt_month")
    coef = lr.stages[-1].coefficients.toArray()
    pdf = frame.select("x1", "x2", "item_cnt_month").toPandas()
    X = np.column_stack([np.ones(len(pdf)), pdf.x1, pdf.x2])
    exp = np.linalg.lstsq(X, pdf.item_cnt_month.to_numpy(), rcond=None)[0]
    assert lr.stages[-1].intercept == pytest.approx(exp[0], abs=1e-8)
    assert np.allclose(coef, exp[1:], atol=1e-8)


def test_score_inverts_log(frame):
    lg = frame.withColumn("y", F.log1p("item_cnt_month"))
    m = models.fit_linear(lg, ["x1", "x2"], "y")
    out = models.score(m, lg, invert_log=True, clip_range=None)
    assert out.agg(F.min("item_cnt_month")).first()[0] > -1.0


def test_reference_boosted_settings_are_valid(frame):
    """H7 / H8 parameter sets map onto Spark ML names (few rounds here)."""
    feats = ["x1", "x2"]
    for params in (models.BOOSTED_SLOW, models.BOOSTED_MATRIX, models.BOOSTED_ES):
        m = models.fit_boosted(frame, feats, "item_cnt_month", **dict(params, maxIter=3))
        assert len(m.stages[-1].trees) == 3


def test_model_round_trip(spark, frame):
    import os
    import uuid
    from pyspark.ml import PipelineModel
    from unitcast.config import scratch_path
    from unitcast.sources.files import save_model
    m = models.fit_linear(frame, ["x1", "x2"], "item_cnt_month")
    path = scratch_path(spark, f"model-{uuid.uuid4().hex}")
    save_model(m, path)
    assert os.path.isdir(path)
    a = [r.item_cnt_month for r in models.score(m, frame, clip_range=None).collect()]
    b = [r.item_cnt_month for r in models.score(PipelineModel.load(path), frame, clip_range=None).collect()]
    assert a == b


def test_tree_memory_budget(spark):
    assert models._memory_mb("1g") == 1024 and models._memory_mb("512m") == 512
    assert models._memory_mb("2048") == 2048 and models._memory_mb("4gb") == 4096
    assert 64 <= models.tree_memory_mb(spark) <= 1024


def test_in_sample_error_beats_mean(frame):
    from unitcast.operators import aggregate as agg
    feats = ["x1", "x2", "shop_id", "item_id"]
    base = frame.agg(F.stddev_pop("item_cnt_month")).first()[0]      # RMSE of predicting the mean
    for m in (models.fit_forest(frame, feats, "item_cnt_month", num_trees=5, max_depth=6),
              models.fit_boosted(frame, feats, "item_cnt_month", maxIter=10, maxDepth=4, seed=1),
              models.fit_linear(frame, feats, "item_cnt_month")):
        fitted = m.transform(frame)
        assert agg.rmse(fitted, "item_cnt_month", "prediction").first()[0] <= base


def test_prediction_rows_equal_request_rows(spark, frame):
    train, _, _ = models.temporal_split(frame, holdout=10, target=11)
    request = frame.filter(F.col("date_block_num") == 11).withColumn("ID", F.monotonically_increasing_id())
    m = models.fit_linear(train, ["x1", "x2"], "item_cnt_month")
    assert models.score(m, request).select("ID", "item_cnt_month").count() == request.count()


def test_forest_rows_are_ordered_by_their_leading_features(frame):
    feats = ["x2", "shop_id", "x1"]
    order = models.feature_order(frame, feats, "item_cnt_month")
    assert sorted(order) == sorted(feats) and order[0] == "x1"      # the strong signal leads
    rows = models.in_feature_order(frame.repartition(3), order)
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, frame.collect()))
    for part in rows.select(*order).rdd.glom().collect():
        assert part == sorted(part)


def test_forest_is_fitted_on_ordered_rows(frame, monkeypatch):
    seen = []
    monkeypatch.setattr(models, "in_feature_order", lambda rows, order: seen.append((rows.count(), order)) or rows)
    rf = models.fit_forest(frame, ["x2", "x1"], "item_cnt_month", num_trees=2, max_depth=3)
    assert seen == [(frame.count(), ["x1", "x2"])]
    assert not rf.stages[-1].getOrDefault("cacheNodeIds")


def test_order_of_constant_missing_and_nan_features(frame):
    df = (frame.withColumn("same", F.lit(3.0)).withColumn("none", F.lit(None).cast("double"))
          .withColumn("nan", F.when(F.col("shop_id") > 2, F.lit(float("nan"))).otherwise(1.0)))
    assert models.feature_order(df, ["same", "none", "nan", "x2", "x1"], "item_cnt_month") == ["x1", "x2", "same", "none", "nan"]
    rf = models.fit_forest(df, ["same", "x1", "x2"], "item_cnt_month", num_trees=3, max_depth=4)
    assert rf.stages[0].getInputCols() == ["same", "x1", "x2"]
    assert models.importances(rf, ["same", "x1", "x2"])[-1] == ("same", 0.0)
