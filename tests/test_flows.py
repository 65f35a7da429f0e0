"""Script flows and model bundles, from the original CSV layout (tiny hand-made files)."""

import os

import pytest
from pyspark.sql import functions as F

from unitcast.plans import flows, pipelines
from unitcast.operators import models
from unitcast.sources import bundle as bundles
from unitcast.sources import files, tpch


@pytest.fixture(scope="module")
def data_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("csv")
    texts = {
        "items.csv": "item_id,item_name,item_category_id\n" + "".join(f"{i},part {i % 3} bolt,{i % 2 + 1}\n" for i in range(10, 18)),
        "item_categories.csv": "item_category_id,item_category_name\n1,Parts - Bolts\n2,Parts - Gears\n",
        "shops.csv": "shop_id,shop_name\n1,Alpha Store\n2,Beta Store\n",
        "test.csv": "ID,shop_id,item_id\n0,1,10\n1,2,11\n2,1,12\n3,9,10\n4,2,99\n",
        "sales_train.csv": "date,date_block_num,shop_id,item_id,item_price,item_cnt_day\n" + "".join(
            f"{d:02d}.{m % 12 + 1:02d}.2013,{m},{s},{i},{10.0 + i},{(i * s + m + d) % 6}\n"
            for m in range(6) for s in (1, 2) for i in range(10, 18) for d in (1, 2) if (i + s + m) % 3),
    }
    for name, text in texts.items():
        (d / name).write_text(text)
    return str(d)


@pytest.fixture(scope="module")
def tables(spark, data_dir):
    return files.read_csv_tables(spark, data_dir)


def args(t):
    return [t[k] for k in ("sales", "request", "items", "categories", "shops")]


@pytest.fixture(scope="module")
def forest(tables):
    return flows.fit(flows.FLOWS["forest"], *args(tables), 5, 6, num_trees=3, max_depth=4)


def test_forest_flow_equals_the_frames_of_the_pipeline(tables, forest):
    hist, req = pipelines.flat_model_tables(*args(tables), holdout_month=5, target_month=6)
    feats = models.feature_columns(hist, "item_cnt_month")
    assert feats == forest.features
    direct = models.fit_forest(hist.orderBy(*pipelines.KEYS).coalesce(1), feats, "item_cnt_month", num_trees=3, max_depth=4)
    assert direct.stages[-1].getNumTrees == 3
    want = {r.ID: tuple(r[f] for f in feats) for r in req.select("ID", *feats).collect()}
    rows = flows.encoded(flows.enrich(flows.request_rows(tables["request"], forest.settings), forest.tables), forest.tables)
    assert {r.ID: tuple(r[f] for f in feats) for r in rows.select("ID", *feats).collect()} == want


def test_saved_and_loaded_in_another_session(spark, tables, forest, tmp_path):
    path = str(tmp_path / "bundle")
    before = {r.ID: r.item_cnt_month for r in flows.score(forest, tables["request"]).collect()}
    assert bundles.save_bundle(forest, path) == 1 and bundles.versions(spark, path) == [1]
    back = bundles.load_bundle(spark.newSession(), path)
    assert back.features == forest.features and back.settings == forest.settings
    after = {r.ID: r.item_cnt_month for r in flows.score(back, tables["request"]).collect()}
    assert after == before and set(after) == {0, 1, 2, 3, 4}
    rows = flows.encoded(flows.enrich(flows.request_rows(tables["request"], back.settings), back.tables), back.tables)
    codes = {r.ID: r for r in rows.collect()}
    assert codes[3].shop_name == -1 and codes[4].item_name == -1 and codes[0].shop_name == 0     # unknown values


def test_versions_and_unfinished_saves(spark, forest, tmp_path):
    path = str(tmp_path / "bundle")
    with pytest.raises(bundles.BundleError):
        bundles.load_bundle(spark, path)
    assert bundles.save_bundle(forest, path) == 1 and bundles.save_bundle(forest, path) == 2
    os.remove(os.path.join(path, "v2", bundles.DESCRIPTION, "_SUCCESS"))    # as if the save had died
    assert bundles.versions(spark, path) == [1]
    assert bundles.load_bundle(spark, path).features == forest.features
    assert bundles.save_bundle(forest, path) == 3
    with pytest.raises(bundles.BundleError):
        bundles.load_bundle(spark, path, 2)


def test_a_changed_table_is_refused(spark, forest, tmp_path):
    path = str(tmp_path / "bundle")
    bundles.save_bundle(forest, path)
    spark.createDataFrame([("x", 0)], "value string, code int").write.mode("overwrite").parquet(f"{path}/v1/tables/codes_shop_name")
    with pytest.raises(bundles.BundleError, match="codes_shop_name"):
        bundles.load_bundle(spark, path)


@pytest.mark.parametrize("flow, params", [("linear", {}), ("forest_text", dict(num_trees=2, max_depth=3)),
                                          ("boosted_text", dict(minInstancesPerNode=1, maxDepth=2, max_rounds=3)),
                                          ("forest_top6", dict(num_trees=2, max_depth=3))])
def test_one_call_from_csv_to_predictions(spark, data_dir, tmp_path, flow, params):
    out, keep = str(tmp_path / "out"), str(tmp_path / "kept")
    made = flows.run_csv(spark, data_dir, flow, out, 5, 6, keep=keep, **params)
    rows = files.read_predictions(spark, out).collect()
    assert sorted(r.ID for r in rows) == [0, 1, 2, 3, 4] and all(0 <= r.item_cnt_month <= 20 for r in rows)
    again = flows.score(bundles.load_bundle(spark, keep), files.read_csv_tables(spark, data_dir)["request"]).collect()
    assert {r.ID: r.item_cnt_month for r in again} == pytest.approx({r.ID: r.item_cnt_month for r in rows}, abs=1e-9)
    if flow == "forest_top6":
        assert len(made.features) == 6


def test_a_table_rewritten_at_its_path_is_read_anew(spark, tmp_path, smoke_dir):
    for name in tpch.MODEL_TABLES:
        spark.read.parquet(f"{smoke_dir}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    before = tpch.categories(spark, str(tmp_path)).count()
    part = spark.read.parquet(f"{smoke_dir}/part.parquet")
    part.filter(F.col("p_brand") == part.first().p_brand).write.mode("overwrite").parquet(str(tmp_path / "part.parquet"))
    assert 0 < tpch.categories(spark, str(tmp_path)).count() < before
