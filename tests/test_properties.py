"""Randomised checks against plain-Python versions written from the spec."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from unitcast.operators import aggregate as agg
from unitcast.operators import clean, models, panel
from unitcast.operators.ids import consecutive_ids

T, S, I = "date_block_num", "shop_id", "item_id"


def random_panel(seed, n_shops=4, n_items=5, months=14, p_row=0.6, p_zero=0.4):
    rng = np.random.default_rng(seed)
    rows = []
    for m in range(months):
        for s in range(n_shops):
            for i in range(n_items):
                if rng.random() < p_row:
                    v = 0.0 if rng.random() < p_zero else float(rng.integers(1, 9))
                    rows.append((m, s, i, v))
    return pd.DataFrame(rows, columns=[T, S, I, "item_cnt_month"])


def loop_pair_recency(pdf):
    """Walk rows in (month, shop, item) order with a per-pair memory."""
    memo, out = {}, {}
    for r in pdf.sort_values([T, S, I]).itertuples(index=False):
        key = (r.shop_id, r.item_id)
        val = -1
        if key not in memo:
            if r.item_cnt_month != 0:
                memo[key] = r.date_block_num
        else:
            val = r.date_block_num - memo[key]
            memo[key] = r.date_block_num
        out[(r.date_block_num, r.shop_id, r.item_id)] = val
    return out


def loop_item_recency(pdf):
    memo, out = {}, {}
    for r in pdf.sort_values([T, S, I]).itertuples(index=False):
        key = r.item_id
        val = -1
        if key not in memo:
            if r.item_cnt_month != 0:
                memo[key] = r.date_block_num
        elif r.date_block_num > memo[key]:
            val = r.date_block_num - memo[key]
            memo[key] = r.date_block_num
        out[(r.date_block_num, r.shop_id, r.item_id)] = val
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_recency_windows_match_loops(spark, seed):
    pdf = random_panel(seed)
    df = spark.createDataFrame(pdf)
    got6 = {(r[T], r[S], r[I]): r.item_shop_last_sale for r in panel.pair_recency(df).collect()}
    got7 = {(r[T], r[S], r[I]): r.item_last_sale for r in panel.item_recency(df).collect()}
    assert got6 == loop_pair_recency(pdf)
    assert got7 == loop_item_recency(pdf)


@pytest.mark.parametrize("seed", [4, 5])
def test_lags_match_self_join(spark, seed):
    pdf = random_panel(seed)
    df = spark.createDataFrame(pdf)
    lags = [1, 2, 6]
    got = {(r[T], r[S], r[I]): tuple(r[f"item_cnt_month_lag_{k}"] for k in lags)
           for r in panel.add_lags(df, "item_cnt_month", lags).collect()}
    idx = {(r.date_block_num, r.shop_id, r.item_id): r.item_cnt_month for r in pdf.itertuples(index=False)}
    exp = {(m, s, i): tuple(idx.get((m - k, s, i)) for k in lags) for (m, s, i) in idx}
    assert got == exp


def test_share_index_averages_one(spark):
    pdf = random_panel(6)
    pdf["item_cnt_month"] += 1.0
    s = agg.share_index(spark.createDataFrame(pdf), I, "item_cnt_month", "idx")
    vals = [r.idx for r in s.collect()]
    assert np.mean(vals) == pytest.approx(1.0)


@pytest.mark.parametrize("n,max_exact", [(1, 10), (2, 10), (999, 50), (2000, 64), (5000, 100_000)])
def test_exact_median(spark, n, max_exact):
    rng = np.random.default_rng(n)
    vals = np.round(rng.normal(100, 30, size=n), 1)   # many ties
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    got = clean.exact_median(df, "v", max_exact=max_exact, accuracy=100)
    assert got == pytest.approx(float(np.median(vals)), abs=1e-9)


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_consecutive_ids_with_payload(spark, reuse):
    keep = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        df = spark.range(200_000).selectExpr("pmod(xxhash64(id), 1000000007) AS a", "id AS b", "repeat('x', 20) AS pay")
        got = consecutive_ids(df, ["a", "b"], "id", partitions=16)
        row = got.agg(F.count_distinct("id").alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi")).first()
        assert (row.n, row.lo, row.hi) == (200_000, 0, 199_999)
        pairs = got.alias("x").join(got.alias("y"), F.expr("x.id + 1 = y.id")).filter("x.a > y.a").count()
        assert pairs == 0
    finally:
        spark.conf.set("spark.sql.exchange.reuse", keep)


def test_consecutive_ids(spark):
    rng = np.random.default_rng(9)
    keys = sorted({(int(a), int(b)) for a, b in rng.integers(0, 50, size=(400, 2))})
    df = spark.createDataFrame(keys[::-1], "a long, b long").repartition(5)
    got = {(r.a, r.b): r.id for r in consecutive_ids(df, ["a", "b"], "id").collect()}
    assert got == {k: i for i, k in enumerate(keys)}


def test_dedupe_keep_first_matches_pandas(spark):
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"k": rng.integers(0, 20, 300), "o": rng.permutation(300), "v": rng.normal(size=300)})
    got = {r.k: (r.o, r.v) for r in clean.dedupe_keep_first(spark.createDataFrame(pdf), ["k"], ["o"]).collect()}
    exp = pdf.sort_values("o").drop_duplicates("k")
    assert got == {r.k: (r.o, r.v) for r in exp.itertuples(index=False)}


def test_best_round():
    assert models.best_round([5, 4, 3, 3.5, 3.6, 3.7, 3.8, 3.9, 2.0], patience=5) == 3
    assert models.best_round([5, 4, 3, 3.5, 2.0], patience=5) == 5
    assert models.best_round([1.0], patience=5) == 1


def test_union_domain_covers_both(spark):
    a = spark.createDataFrame([("x",), ("y",)], "c string")
    b = spark.createDataFrame([("y",), ("z",), (None,)], "c string")
    from unitcast.operators.encode import encode_fit
    assert sorted(r.value for r in encode_fit(a, b, c="c").collect()) == ["x", "y", "z"]


def test_lag_matrix_rows_cover_all_pairs(spark):
    pdf = random_panel(12)
    df = spark.createDataFrame(pdf)
    lm = panel.lag_matrix(df, [13], n_lags=3)
    assert lm.count() == pdf[[S, I]].drop_duplicates().shape[0]
    assert lm.filter(F.col("lag_0") < 0).count() == 0


def _ref_trend(vals):
    """Scan in order; a missing value stops the scan (becomes 0); 0 moves on."""
    for v in vals:
        if v is None:
            return 0.0
        if v != 0:
            return v
    return 0.0


def _first_valid(vals):
    return next((v for v in vals if v is not None and v != 0), 0.0)


def test_trend_modes_match_python(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st
    from unitcast.functions.columns import first_truthy

    cell = st.one_of(st.none(), st.just(0.0), st.floats(-2, 2, allow_nan=False, allow_infinity=False))

    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.lists(cell, min_size=6, max_size=6), min_size=1, max_size=300))
    def check(rows):
        cols = [f"d{k}" for k in range(6)]
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                                   "id int, " + ", ".join(f"{c} double" for c in cols))
        out = df.select("id", first_truthy(cols).alias("ref"), first_truthy(cols, "first_valid").alias("fv"))
        got = {r.id: (r.ref, r.fv) for r in out.collect()}
        assert got == {i: (_ref_trend(r), _first_valid(r)) for i, r in enumerate(rows)}

    check()


def test_price_trend_rollup_equals_direct(spark):
    """Month-item prices rolled up from stored (month, shop, item) cells equal
    the ones computed from the sales rows (exact decimal sums)."""
    from unitcast.plans import pipelines
    rng = np.random.default_rng(31)
    n = 3000
    sales = pd.DataFrame({T: rng.integers(0, 10, n).astype("int32"), S: rng.integers(0, 6, n),
                          I: rng.integers(0, 8, n), "item_cnt_day": rng.integers(-1, 5, n).astype(float),
                          "item_price": np.round(rng.uniform(1, 500, n), 2) / rng.integers(1, 33, n)})
    df = spark.createDataFrame(sales)
    cells = pipelines.panel_cells(df, holdout_month=9)
    p = pipelines.request_panel(df, df.select(S, I).distinct(), 10, 9, cells=cells)
    a = panel.price_trend(p, pipelines.panel_sales(df, 9), mode="first_valid")
    b = panel.price_trend(p, mode="first_valid", month_item_stats=pipelines.month_item_stats(cells))
    key = [T, S, I]
    ga = {tuple(r[k] for k in key): r.delta_price_lag for r in a.collect()}
    gb = {tuple(r[k] for k in key): r.delta_price_lag for r in b.collect()}
    assert ga == gb and any(v != 0 for v in ga.values())
