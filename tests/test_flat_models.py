"""The flat-table models train on every observed shop x item month."""

from pyspark.sql import functions as F

from unitcast import config
from unitcast.plans import frames, modelq
from unitcast.sources import tpch


def test_flat_models_train_on_the_checked_frame(spark, smoke_dir):
    hist, req, feats, model = modelq._forest(spark, smoke_dir)
    months = (tpch.sales(spark, smoke_dir).filter(F.col("date_block_num") <= config.HOLDOUT_MONTH)
              .select("date_block_num", "shop_id", "item_id").distinct())
    assert hist.count() == months.count() > 3750        # more than nations x categories
    assert hist.agg(F.max(modelq.LABEL)).first()[0] == config.CLIP_HI == 20.0
    checked = frames.q_flat_model_frame(spark, smoke_dir).select("date_block_num", "shop_id", "item_id", modelq.LABEL)
    assert checked.exceptAll(hist.select(checked.columns)).count() == 0
    assert req.count() == tpch.request(spark, smoke_dir).count()
    assert model.stages[-1].getNumTrees == 25 and "item_id" in feats
