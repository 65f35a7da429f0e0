"""Carried state, appended months, means as of each month, months taken from the data."""

import os
import random

import pytest
from pyspark.sql import functions as F

from unitcast.operators import asof, panel, state
from unitcast.plans import modelq, textual
from unitcast.sources import files

ROW = "date_block_num int, shop_id long, item_id long, item_cnt_month double"
LAGS = [f"item_cnt_month_lag_{k}" for k in (1, 2, 3, 6, 12)]
MADE = [*LAGS, "item_shop_last_sale", "item_last_sale"]


@pytest.fixture(scope="module")
def gaps(spark):
    """A panel with gaps, months without any row, zeros and pairs that start late."""
    draw, rows = random.Random(8), []
    for m in (m for m in range(18) if m not in (4, 5)):
        for s in (1, 2, 3):
            for i in (10, 11, 12):
                if draw.random() < 0.55 and not (i == 12 and m < 9):
                    rows.append((m, s, i, float(draw.choice([0, 0, 0, 1, 7]))))
    return spark.createDataFrame(rows, ROW).repartition(3).cache()


def rows_of(df):
    return sorted(tuple(r[c] for c in ("date_block_num", "shop_id", "item_id", *MADE)) for r in df.collect())


def test_state_equals_the_full_panel_in_every_month(spark, gaps):
    full = panel.item_recency(panel.pair_recency(panel.add_lags(gaps, "item_cnt_month", (1, 2, 3, 6, 12))))
    want = rows_of(full)
    pairs, items = state.pair_state(gaps, -1), state.item_state(gaps, -1)
    got = []
    for m in range(18):
        now = gaps.filter(F.col("date_block_num") == m)
        got += rows_of(state.features(now, pairs, items, m))
        if now.count():
            pairs = spark.createDataFrame(state.advance_pairs(pairs, now, m).collect(), pairs.schema)
            items = spark.createDataFrame(state.advance_items(items, now, m).collect(), items.schema)
        if m in (0, 8, 17):     # carried state equals the state of the whole history
            at = pairs.first()["at"]
            for carried, whole in ((pairs, state.pair_state(gaps, at)), (items, state.item_state(gaps, at))):
                assert sorted(map(str, carried.collect())) == sorted(map(str, whole.select(carried.columns).collect()))
    assert sorted(got) == want


def test_state_with_first_rows_and_no_history(spark, gaps):
    none = gaps.limit(0)
    now = gaps.filter(F.col("date_block_num") == 17)
    out = state.features(now, state.pair_state(none, 16), state.item_state(none, 16), 17)
    assert {tuple(r[c] for c in MADE) for r in out.collect()} == {(None,) * 5 + (-1, -1)}
    first = spark.createDataFrame([(10, 3)], "item_id long, shop_id long")
    rows = spark.createDataFrame([(20, s, 10, 0.0) for s in (1, 2, 3)], ROW)
    got = state.features(rows, state.pair_state(gaps, 17), state.item_state(gaps, 17), 20, first_rows=first).collect()
    assert {r.shop_id for r in got if r.item_last_sale >= 3} == {3}
    assert all(r.item_cnt_month_lag_1 is None and r.item_cnt_month_lag_2 is None for r in got)


def test_as_of_means_see_earlier_months_only(spark):
    monthly = spark.createDataFrame([(0, 1, 10, 4.0), (1, 1, 10, 6.0), (3, 1, 10, None), (4, 1, 10, 1.0), (4, 2, 10, 9.0)], ROW)
    sales = spark.createDataFrame([(0, 10, 2.0), (0, 10, 4.0), (1, 10, 9.0), (4, 10, 1000.0)], "date_block_num int, item_id long, item_price double")
    got = {(r.date_block_num, r.shop_id): (r.item_cnt_month_mean_as_of, r.item_cnt_prev_month, r.item_price_mean_as_of)
           for r in asof.as_of_means(monthly, sales).collect()}
    assert got == {(0, 1): (None, None, None), (1, 1): (4.0, 4.0, 3.0), (3, 1): (5.0, None, 5.0), (4, 1): (5.0, None, 5.0), (4, 2): (None, None, 5.0)}
    later = monthly.filter("date_block_num < 4").unionByName(spark.createDataFrame([(9, 1, 10, 777.0)], ROW))
    again = {(r.date_block_num, r.shop_id): r.item_cnt_month_mean_as_of for r in asof.as_of_means(later, sales).collect()}
    assert all(again[k] == got[k][0] for k in again if k in got)        # a later month changes nothing before it


def _files(path):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, names in os.walk(path) for n in names if n.startswith("part")}


def test_append_touches_only_its_month(spark, gaps, tmp_path):
    path = str(tmp_path / "features")
    month = gaps.filter(F.col("date_block_num") == 9)
    files.save_features(gaps.filter(F.col("date_block_num") < 9), path)
    before = _files(path)
    assert files.append_month(month, path, 9)
    after = _files(path)
    assert {p: t for p, t in after.items() if p in before} == before and len(after) > len(before)
    assert not files.append_month(month.orderBy(F.desc("item_id")), path, 9)        # the same rows in another order
    assert _files(path) == after
    key = ["date_block_num", "shop_id", "item_id", "item_cnt_month"]
    want = sorted(map(tuple, gaps.filter(F.col("date_block_num") <= 9).select(key).collect()))
    assert sorted(map(tuple, files.load_features(spark, path).select(key).collect())) == want
    changed = month.withColumn("item_cnt_month", F.lit(5.0))
    assert files.append_month(changed, path, 9) and not files.append_month(changed, path, 9)
    assert files.load_features(spark, path).filter("date_block_num = 9 AND item_cnt_month != 5").isEmpty()
    assert [(r.date_block_num, r.rows) for r in files.months_appended(spark, path).collect()] == [(9, month.count())]
    with pytest.raises(ValueError):
        files.append_month(gaps, path, 9)
    assert not files.append_month(gaps.limit(0), path, 9)


def test_append_after_a_failure_between_data_and_manifest(spark, gaps, tmp_path, monkeypatch):
    path, month = str(tmp_path / "features"), gaps.filter(F.col("date_block_num") == 9)
    with monkeypatch.context() as m:
        m.setattr(files, "_manifest", lambda p: "/proc/none/here")     # the second write fails
        with pytest.raises(Exception):
            files.append_month(month, path, 9)
    assert files.append_month(month, path, 9) and not files.append_month(month, path, 9)
    assert files.load_features(spark, path).count() == month.count()


def test_months_reach_back_to_the_first_sale(spark):
    """A sale before month 0 gets its own month and lag."""
    rows = [(-3, 1, 10, 5.0), (0, 1, 10, 2.0), (2, 2, 11, 4.0)]
    sales = spark.createDataFrame([(m, s, i, n) for m, s, i, n in rows], "date_block_num int, shop_id long, item_id long, item_cnt_day double")
    request = spark.createDataFrame([(0, 1, 10), (1, 2, 11), (2, 9, 9)], "ID long, shop_id long, item_id long")
    out = textual.request_history(sales, request, 2)
    assert out.columns == ["ID", "shop_id", "item_id", *[f"m_{m}" for m in range(-3, 3)]]
    got = {r.ID: tuple(r)[3:] for r in out.collect()}
    assert got == {0: (5.0, 0, 0, 2.0, 0, 0), 1: (0, 0, 0, 0, 0, 4.0), 2: (0,) * 6}
    mx, lags = modelq.request_matrix(spark.createDataFrame(rows, ROW), request, 2, 3)
    assert lags == [f"lag_{k}" for k in range(1, 6)]
    train = {r.ID: r for r in mx.filter("anchor = 2").collect()}
    assert train[0].lag_5 == 5.0 and train[0].lag_2 == 2.0 and train[1].lag_0 == 4.0 and train[2].lag_5 == 0.0
    assert textual.request_history(sales.limit(0), request, 2).columns == ["ID", "shop_id", "item_id"]
