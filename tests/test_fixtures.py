"""Hand-made frames for each quirk (FIXTURES.md section 3)."""

import datetime as dt
import math
import os
import re
import tempfile
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from unitcast.functions.columns import clip, first_truthy
from unitcast.operators import aggregate as agg
from unitcast.operators import clean, encode, models, panel, text
from unitcast.operators.fallback import cold_start_fill
from unitcast.sources import files

T, S, I = "date_block_num", "shop_id", "item_id"


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


# ---- A1-A3, B4 -------------------------------------------------------------

def test_tiny_sales_csv(spark):
    d = tempfile.mkdtemp(prefix="unitcast-csv-")
    path = os.path.join(d, "sales.csv")
    lines = ["date,date_block_num,shop_id,item_id,item_price,item_cnt_day",
             "01.02.2013,1,5,10,100.0,1", "02.02.2013,1,5,10,100.0,-1",
             "03.02.2013,1,5,11,-1,2", "04.02.2013,1,6,11,400000,1",
             "05.03.2013,2,6,12,50.5,3", "06.03.2013,2,6,12,50.5,1"]
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    s = files.read_sales(spark, path)
    first = s.filter(F.col("item_price") == 100.0).orderBy("date").first()
    assert first.date == dt.date(2013, 2, 1)          # day first
    cleaned = clean.clean_outliers(s, price_gt=0, price_lt=300000)
    assert cleaned.count() == 4                        # -1 and 400000 removed
    assert files.read_sales(spark, path, rows_read=2).count() == 2
    assert files.read_sales(spark, path, rows_read=None).count() == 6


# ---- C1 ------------------------------------------------------------------------

def test_dedupe_keep_first(spark):
    data = [("2013-01-01", 0, 1, 1, 2.0, 10.0, 3), ("2013-01-01", 0, 1, 1, 2.0, 11.0, 1),
            ("2013-01-01", 0, 1, 1, 2.0, 12.0, 2), ("2013-01-02", 0, 1, 1, 2.0, 13.0, 4),
            ("2013-01-02", 0, 1, 2, 1.0, 14.0, 5), ("2013-01-02", 0, 1, 2, 1.0, 15.0, 6)]
    df = spark.createDataFrame(data, "date string, block int, shop long, item long, cnt double, "
                                     "price double, seq int")
    out = clean.dedupe_keep_first(df, ["date", "block", "shop", "item", "cnt"], ["seq"])
    got = sorted(rows(out, "date", "item", "price"))
    assert got == [("2013-01-01", 1, 11.0), ("2013-01-02", 1, 13.0), ("2013-01-02", 2, 14.0)]


# ---- D4, F1, F2 -------------------------------------------------------------------

def gap_panel(spark):
    data = [(m, 1, 1, float(m)) for m in (1, 2, 5, 6)] + [(m, 2, 1, 10.0) for m in range(0, 7)]
    return spark.createDataFrame(data, "date_block_num int, shop_id long, item_id long, item_cnt_month double")


def test_lags_use_month_values_not_rows(spark):
    p = panel.add_lags(gap_panel(spark), "item_cnt_month", [1, 3])
    got = {r[T]: (r.item_cnt_month_lag_1, r.item_cnt_month_lag_3)
           for r in p.filter(F.col(S) == 1).collect()}
    assert got == {1: (None, None), 2: (1.0, None), 5: (None, 2.0), 6: (5.0, None)}


def test_month_mean_lag_is_pair_gated(spark):
    p = panel.month_mean_lag(gap_panel(spark))
    got = {r[T]: r.date_avg_item_cnt_lag_1 for r in p.filter(F.col(S) == 1).collect()}
    assert got[5] is None            # month 4 has a mean, but not for this pair
    assert got[6] == (5.0 + 10.0) / 2


def test_dense_panel_is_month_product(spark):
    m = spark.createDataFrame([(0, 1, 1, 3.0), (0, 2, 2, 30.0), (1, 1, 3, -2.0)],
                              "date_block_num int, shop_id long, item_id long, item_cnt_month double")
    for per_task in (2_000_000, 1):     # one salt per month, many salts
        d = panel.dense_panel(m, rows_per_task=per_task)
        got = sorted(rows(d, T, S, I, "item_cnt_month"))
        assert got == [(0, 1, 1, 3.0), (0, 1, 2, 0.0), (0, 2, 1, 0.0), (0, 2, 2, 20.0), (1, 1, 3, 0.0)]


# ---- F5 -------------------------------------------------------------------------

def test_trend_modes(spark):
    df = spark.createDataFrame([(1, None, 0.5, None), (2, 0.0, 0.25, None), (3, None, None, None),
                                (4, 0.0, 0.0, -0.1)], "id int, d1 double, d2 double, d3 double")
    ref = dict(rows(df.select("id", first_truthy(["d1", "d2", "d3"]).alias("t")), "id", "t"))
    fv = dict(rows(df.select("id", first_truthy(["d1", "d2", "d3"], "first_valid").alias("t")), "id", "t"))
    assert ref == {1: 0.0, 2: 0.25, 3: 0.0, 4: -0.1}      # missing lag-1 stops the scan
    assert fv == {1: 0.5, 2: 0.25, 3: 0.0, 4: -0.1}


# ---- F6, F7 -----------------------------------------------------------------------

def test_pair_recency(spark):
    data = [(0, 1, 1, 0.0), (1, 1, 1, 0.0), (2, 1, 1, 5.0), (3, 1, 1, 0.0), (4, 1, 1, 0.0), (6, 1, 1, 3.0)]
    df = spark.createDataFrame(data, "date_block_num int, shop_id long, item_id long, item_cnt_month double")
    got = sorted(rows(panel.pair_recency(df), T, "item_shop_last_sale"))
    assert [v for _, v in got] == [-1, -1, -1, 1, 1, 2]


def test_item_recency_first_row_only(spark):
    data = [(0, 1, 9, 0.0), (0, 2, 9, 4.0), (0, 3, 9, 0.0), (1, 1, 9, 0.0), (1, 2, 9, 0.0),
            (1, 3, 9, 1.0), (3, 2, 9, 2.0)]
    df = spark.createDataFrame(data, "date_block_num int, shop_id long, item_id long, item_cnt_month double")
    first = sorted(rows(panel.item_recency(df), T, S, "item_last_sale"))
    assert [v for *_, v in first] == [-1, -1, -1, 1, -1, -1, 2]
    every = sorted(rows(panel.item_recency(df, all_rows=True), T, S, "item_last_sale"))
    assert [v for *_, v in every] == [-1, -1, -1, 1, 1, 1, 2]


# ---- B11, B17 ----------------------------------------------------------------------

def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(-5.0,), (0.0,), (3.5,), (20.0,), (21.0,), (None,)], "v double")
    got = [r[0] for r in df.select(clip("v")).collect()]
    assert got == [0.0, 0.0, 3.5, 20.0, 20.0, None]
    logs = [r[0] for r in clean.log_target(df.select(clip("v").alias("v")), "v").collect()]
    assert logs[2] == pytest.approx(math.log1p(3.5)) and logs[5] is None


# ---- G1-G6 ------------------------------------------------------------------------

NAMES = [(1, "a  b"), (2, "ab "), (3, "x"), (4, "Москва Центр"), (5, "A - B"), (6, "A"), (7, "A-B-C")]


def test_text_functions(spark):
    df = spark.createDataFrame(NAMES, "id int, name string")
    st = {r.id: (r.name_length, r.name_word_count) for r in text.text_stats(df, "name").collect()}
    assert st == {i: (len(n), len(n.split(" "))) for i, n in NAMES}
    city = {r.id: r.city for r in text.shop_city(df, "name").collect()}
    assert city == {i: n.split(" ")[0] for i, n in NAMES}
    ts = {r.id: (r.type, r.subtype) for r in text.category_type_subtype(df, "name").collect()}
    assert ts[5] == ("A", "B") and ts[6] == ("A", "A") and ts[7] == ("A", "B")


def test_label_encode_binary_order_and_union(spark):
    a = spark.createDataFrame([("b",), ("B",), ("a",)], "c string")
    b = spark.createDataFrame([("c",), ("a",)], "c string")
    codes = dict(rows(encode.encode_fit(a, b, c="c"), "value", "code"))
    assert codes == {"B": 0, "a": 1, "b": 2, "c": 3}
    out = encode.encode_apply(spark.createDataFrame([("zz",), ("c",)], "c string"), "c", codes=encode.encode_fit(a, c="c"))
    assert sorted(r.c for r in out.collect()) == [-1, -1]


# ---- G3 ---------------------------------------------------------------------------

def brute_tfidf(docs, k=25):
    tok = {i: re.findall(r"(?u)\b\w\w+\b", t.lower()) for i, t in docs}
    total = Counter(w for ws in tok.values() for w in ws)
    dfreq = Counter(w for ws in tok.values() for w in set(ws))
    vocab = sorted(sorted(total, key=lambda w: (-total[w], w))[:k])
    n = len(docs)
    idf = {w: math.log((1 + n) / (1 + dfreq[w])) + 1 for w in vocab}
    out = {}
    for i, ws in tok.items():
        c = Counter(w for w in ws if w in idf)
        norm = math.sqrt(sum((c[w] * idf[w]) ** 2 for w in c))
        for w in c:
            out[(i, w)] = (vocab.index(w), c[w] * idf[w] / norm)
    return vocab, out


def test_tfidf_ties_and_empty_doc(spark):
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(6) for j in range(6)]     # 36 terms
    docs = [(1, " ".join(words[:30])), (2, " ".join(words[:20])), (3, " ".join(words[20:36])),
            (4, "x y z"), (5, "wаа Éclair éclair")]
    df = spark.createDataFrame(docs, "id long, txt string")
    vocab = text.tfidf_fit(df, "id", "txt")
    exp_vocab, exp = brute_tfidf(docs)
    assert [r.term for r in vocab.orderBy("idx").collect()] == exp_vocab
    got = {(r.id, r.term): (r.idx, r.weight) for r in text.tfidf(df, "id", "txt").collect()}
    assert set(got) == set(exp)
    for key, (idx, w) in exp.items():
        assert got[key][0] == idx and got[key][1] == pytest.approx(w, abs=1e-12)
    assert not any(i == 4 for i, _ in got)            # no kept term -> no rows


# ---- G7 ---------------------------------------------------------------------------

def test_category_groups(spark):
    ids = [0, 1, 7, 8, 9, 10, 17, 18, 24, 25, 26, 27, 28, 78, 79]
    df = spark.createDataFrame([(i, f"name{i}") for i in ids], "item_category_id int, item_category_name string")
    got = dict(rows(clean.category_groups(df), "item_category_id", "cats"))
    assert got == {0: "name0", 1: "Access", 7: "Access", 8: "name8", 9: "name9", 10: "Consoles",
                   17: "Consoles", 18: "Consoles Games", 24: "Consoles Games", 25: "name25",
                   26: "phone games", 27: "phone games", 28: "CD games", 78: "Soft", 79: "name79"}


# ---- H11 --------------------------------------------------------------------------

def test_cold_start_levels(spark):
    preds = spark.createDataFrame([(1, 10, 2.0), (1, 11, 4.0), (2, 10, 6.0)],
                                  "shop_id long, item_id long, pred double")
    req = spark.createDataFrame([(0, 1, 10), (1, 2, 11), (2, 1, 99), (3, 7, 10)],
                                "ID long, shop_id long, item_id long")
    got = dict(rows(cold_start_fill(req, preds), "ID", "item_cnt_month"))
    # shop sums 6, 6 -> index 1; item sums 8, 4 -> mean 6 -> 4/3, 2/3; v = 2.0 (only ID 0 has a pred)
    assert got[0] == 2.0
    assert got[1] == pytest.approx(2.0 * 1.0 * (4 / 6) * 0.225)
    assert got[2] == pytest.approx(2.0 * 1.0 * 0.225)
    assert got[3] is None                              # unknown shop stays NULL
    flat = dict(rows(cold_start_fill(req, preds, use_item_index=False), "ID", "item_cnt_month"))
    assert flat[3] == pytest.approx(2.0 * 0.225)


# ---- F9, H3 -----------------------------------------------------------------------

def test_lag_matrix_and_linear_fit(spark):
    rng = np.random.default_rng(7)
    data = []
    for shop in range(40):
        vals = rng.integers(0, 10, size=12).astype(float)
        for m, v in enumerate(vals):
            data.append((m, shop, 1, float(v)))
    m = spark.createDataFrame(data, "date_block_num int, shop_id long, item_id long, item_cnt_month double")
    lm = panel.lag_matrix(m, [11, 12], n_lags=5)
    row = lm.filter((F.col("anchor") == 12) & (F.col(S) == 0)).first()
    assert row.lag_0 == 0.0 and row.lag_1 == data[11][3] and row.lag_5 == data[7][3]
    # exact relation y = 1 + 2*lag_1 - lag_2 recovered by least squares
    tr = lm.filter(F.col("anchor") == 11).withColumn("y", 1 + 2 * F.col("lag_1") - F.col("lag_2"))
    feats = [f"lag_{k}" for k in range(1, 6)]
    model = models.fit_linear(tr, feats, "y")
    coef = model.stages[-1].coefficients.toArray()
    assert model.stages[-1].intercept == pytest.approx(1.0, abs=1e-6)
    assert np.allclose(coef, [2, -1, 0, 0, 0], atol=1e-6)


# ---- C4, C5 -----------------------------------------------------------------------

def test_union_aligned(spark):
    a = spark.createDataFrame([(1, 2.0)], "k int, x double")
    b = spark.createDataFrame([(2, "s")], "k int, y string")
    out = {r.k: (r.x, r.y) for r in panel.union_aligned(a, b).collect()}
    assert out == {1: (2.0, None), 2: (None, "s")}
    filled = {r.k: r.x for r in panel.union_aligned(a, b, fill=0.0).collect()}
    assert filled == {1: 2.0, 2: 0.0}
    dom = sorted(r.value for r in encode.union_domain(a.select(F.col("k").cast("string").alias("c")),
                                                      b.select(F.col("y").alias("c")), c="c").collect())
    assert dom == ["1", "s"]


# ---- E10, E16, E17 ----------------------------------------------------------------

def test_share_index_and_metrics(spark):
    df = spark.createDataFrame([(1, 3.0), (1, 1.0), (2, 2.0), (3, 6.0)], "k long, v double")
    idx = dict(rows(agg.share_index(df, "k", "v"), "k", "share"))
    assert idx == pytest.approx({1: 1.0, 2: 0.5, 3: 1.5})
    e = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (3.0, 2.5)], "y double, p double")
    assert agg.rmse(e, "y", "p").first()[0] == pytest.approx(math.sqrt((0.25 + 0 + 0.25) / 3))
    assert agg.r2_percent(e, "y", "p").first()[0] == pytest.approx(75.0)
