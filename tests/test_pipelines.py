"""End-to-end pipelines on the original CSV layout (tiny hand-made files)."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from unitcast.plans import pipelines
from unitcast.sources.files import read_csv_tables


@pytest.fixture(scope="module")
def tables(spark):
    d = tempfile.mkdtemp(prefix="unitcast-csvdir-")
    files = {
        # column orders differ from the schema on purpose
        "items.csv": "item_name,item_id,item_category_id\nred bolt,10,1\nblue bolt,11,1\nnew gear,12,2\n",
        "item_categories.csv": "item_category_name,item_category_id\nParts - Bolts,1\nParts - Gears,2\n",
        "shops.csv": "shop_name,shop_id\nAlpha Store,1\nBeta Store,2\n",
        "test.csv": "ID,shop_id,item_id\n0,1,10\n1,2,11\n2,1,12\n3,9,10\n",
    }
    sales = ["date,date_block_num,shop_id,item_id,item_price,item_cnt_day"]
    for m in range(4):
        for shop, item, cnt in ((1, 10, 2 + m), (2, 11, 1), (1, 11, 0 if m % 2 else 3)):
            sales.append(f"{1 + m:02d}.{m % 12 + 1:02d}.2013,{m},{shop},{item},{10.0 + m},{cnt}")
    files["sales_train.csv"] = "\n".join(sales) + "\n"
    for name, text in files.items():
        with open(os.path.join(d, name), "w") as fh:
            fh.write(text)
    return read_csv_tables(spark, d)


def test_csv_tables_typed(tables):
    assert tables["items"].schema["item_id"].dataType.simpleString() == "bigint"
    first = tables["sales"].orderBy("date").first()
    assert str(first.date) == "2013-01-01" and first.item_cnt_day == 2.0


def test_panel_feature_table(tables):
    ft = pipelines.panel_feature_table(tables["sales"], tables["request"], target_month=4, holdout_month=3)
    # months 0-3: shops {1,2} x items {10,11} = 4 rows each; request month: 4 rows
    assert ft.count() == 4 * 4 + 4
    row = ft.filter((F.col("date_block_num") == 3) & (F.col("shop_id") == 1) & (F.col("item_id") == 10)).first()
    assert row.item_cnt_month == 5.0 and row.item_cnt_month_lag_1 == 4.0 and row.item_cnt_month_lag_2 == 3.0
    assert row.item_shop_last_sale == 1


def test_regression_predictions(tables):
    out = pipelines.regression_predictions(tables["sales"], tables["request"], holdout_month=3,
                                           target_month=4, n_lags=2)
    got = {r.ID: r.item_cnt_month for r in out.collect()}
    assert sorted(got) == [0, 1, 2, 3]
    assert all(0.0 <= v <= 20.0 for v in got.values() if v is not None)
    assert got[3] is None            # unknown shop: no fallback level applies


def test_model_frames_from_csv(tables):
    hist, req = pipelines.flat_model_tables(tables["sales"], tables["request"], tables["items"],
                                            tables["categories"], tables["shops"], holdout_month=3,
                                            target_month=4, with_text=True)
    assert req.count() == 4 and hist.count() == 12
    assert {"shop_name", "item_name", "item_name_tfidf_0", "shop_name_word_count"} <= set(hist.columns)
    assert dict(hist.dtypes)["item_name"] == "bigint"                  # label-encoded
    unknown = req.filter(F.col("ID") == 3).first()
    assert unknown.shop_name == -1                                     # shop 9 is not in shops.csv
    pm = pipelines.panel_model_frame(tables["sales"], tables["request"], tables["items"],
                                     tables["categories"], tables["shops"], target_month=4, holdout_month=3)
    assert {"city_code", "type_code", "subtype_code", "item_category_id"} <= set(pm.columns)
    assert pm.count() == 20


def test_request_month_year_follows_the_sales(tables):
    _, req = pipelines.flat_model_tables(tables["sales"], tables["request"], tables["items"], tables["categories"],
                                         tables["shops"], holdout_month=3, target_month=12)
    assert {(r.year, r.month) for r in req.select("year", "month").collect()} == {(2014, 1)}


def test_free_item_and_request_order(spark):
    """An item of price 0 has trend 0; the request month's first row is the lowest ID, not the lowest shop."""
    rows = [(m, s, i, 0.0 if i == 7 else 5.0 + m, 2.0) for m in range(3) for s in (1, 2) for i in (7, 8)]
    sales = spark.createDataFrame(rows, "date_block_num int, shop_id long, item_id long, item_price double, item_cnt_day double")
    request = spark.createDataFrame([(0, 2, 8), (1, 1, 8), (2, 1, 7)], "ID long, shop_id long, item_id long")
    ft = pipelines.panel_feature_table(sales, request, target_month=3, holdout_month=2)
    got = {(r.date_block_num, r.shop_id, r.item_id): r for r in ft.collect()}
    assert all(r.delta_price_lag == 0.0 for k, r in got.items() if k[2] == 7)
    assert got[3, 2, 8].item_last_sale == 1 and got[3, 1, 8].item_last_sale == -1


def test_cleaning_chain(spark):
    sales = spark.createDataFrame([(0, 0, 5, -1.0, 1.0), (0, 57, 5, 10.0, 1.0), (0, 57, 5, 30.0, 1.0), (0, 3, 6, 900.0, 1.0),
                                   (0, 3, 6, 200000.0, 1.0)],
                                  "date_block_num int, shop_id long, item_id long, item_price double, item_cnt_day double")
    request = spark.createDataFrame([(0, 0, 5), (1, 3, 6)], "ID long, shop_id long, item_id long")
    s, r = pipelines.clean_inputs(sales, request, {0: 57}, bad_price_lt=0.0, like={"item_id": 5})
    assert sorted((x.shop_id, x.item_price) for x in s.collect()) == [(3, 900.0), (57, 10.0), (57, 20.0), (57, 30.0)]
    assert sorted(x.shop_id for x in r.collect()) == [3, 57]


def test_saving_a_split_twice_replaces_it(spark, tmp_path):
    from unitcast.sources.files import save_predictions
    df = spark.createDataFrame([(1, 2.0)], "ID long, item_cnt_month double")
    for split in ("holdout", "request", "holdout"):
        save_predictions(df, str(tmp_path / "p"), split)
    got = spark.read.parquet(str(tmp_path / "p"))
    assert sorted(r.split for r in got.collect()) == ["holdout", "request"]


def test_rows_of_flat_frames_never_carry_names(spark, tables, monkeypatch):
    stored = []
    keep = pipelines.materialize
    monkeypatch.setattr(pipelines, "materialize", lambda df: stored.append(df) or keep(df))
    hist, req = pipelines.flat_model_tables(tables["sales"], tables["request"], tables["items"],
                                            tables["categories"], tables["shops"], 5, 6, with_text=True)
    frames = [df for df in stored if {"shop_id", "item_id"} <= set(df.columns)]
    assert len(frames) >= 3
    assert not [c for df in frames for c, kind in df.dtypes if kind == "string"]
    assert hist.count() and req.count() == tables["request"].count()
