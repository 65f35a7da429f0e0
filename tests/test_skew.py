"""One key holding a third or more of all rows: results stay whole and right."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from unitcast.operators import aggregate as agg
from unitcast.operators import clean, panel

T, S, I = "date_block_num", "shop_id", "item_id"


@pytest.fixture(scope="module")
def hot(spark):
    rng = np.random.default_rng(21)
    n = 6000
    item = np.where(rng.random(n) < 0.4, 7, rng.integers(0, 50, n))          # item 7: ~40 %
    month = np.where(rng.random(n) < 0.4, 3, rng.integers(0, 12, n))         # month 3: ~40 %
    pdf = pd.DataFrame({T: month.astype("int32"), S: rng.integers(0, 20, n), I: item,
                        "cnt": rng.integers(-2, 9, n).astype(float), "seq": rng.permutation(n)})
    return pdf, spark.createDataFrame(pdf).repartition(6)


def test_hot_key_dedupe(hot):
    pdf, df = hot
    got = {(r[T], r[S], r[I]): r.seq for r in clean.dedupe_keep_first(df, [T, S, I], ["seq"]).collect()}
    exp = pdf.sort_values("seq").drop_duplicates([T, S, I])
    assert got == {(r[0], r[1], r[2]): r[4] for r in exp.itertuples(index=False)}


def test_hot_key_share_index(hot):
    pdf, df = hot
    got = {r[I]: r.share for r in agg.share_index(df, I, "cnt").collect()}
    sums = pdf.groupby(I)["cnt"].sum()
    exp = (sums / sums.mean()).to_dict()
    assert got.keys() == exp.keys()
    assert all(got[k] == pytest.approx(exp[k]) for k in exp)


def test_hot_month_product(hot):
    pdf, df = hot
    monthly = agg.monthly_sales(df, value="cnt")
    dense = panel.dense_panel(monthly, rows_per_task=100)   # hot month: ~10 salts
    m = pdf.groupby([T, S, I])["cnt"].sum().reset_index()
    shops = m.groupby(T)[S].nunique()
    items = m.groupby(T)[I].nunique()
    assert dense.count() == int((shops * items).sum())          # every shop x item per month
    hot_sum = dense.filter(F.col(T) == 3).agg(F.sum("item_cnt_month")).first()[0]
    assert hot_sum == pytest.approx(m[m[T] == 3]["cnt"].clip(0, 20).sum())


def test_product_spreads_over_tasks(spark):
    """Tiny key tables, large product: the session's coalescing must not put it into one task."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.parallelismFirst",
                                           "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256m")
    try:
        monthly = spark.range(400).selectExpr("0 AS date_block_num", "id AS shop_id", "id AS item_id",
                                              "1.0D AS item_cnt_month")
        dense = panel.dense_panel(monthly, rows_per_task=10_000)
        assert dense.count() == 160_000
        from unitcast.operators.panel import product
        parts = [r["n"] for r in product(monthly, 10_000).groupBy(F.spark_partition_id()).agg(
            F.count(F.lit(1)).alias("n")).collect()]
        assert sum(parts) == 160_000 and max(parts) < 60_000 and len(parts) >= 8
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_hot_item_recency_counts(hot):
    pdf, df = hot
    monthly = agg.monthly_sales(df, value="cnt").withColumnRenamed("item_cnt_month", "v")
    p = panel.item_recency(monthly.withColumnRenamed("v", "item_cnt_month"))
    first_rows = p.filter(F.col("item_last_sale") >= 0).groupBy(I, T).count()
    assert first_rows.filter(F.col("count") > 1).count() == 0   # one row per item-month at most
    assert p.count() == monthly.count()


def test_hot_value_median(spark):
    vals = np.concatenate([np.full(4000, 42.0), np.arange(8000, dtype=float)])
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    assert clean.exact_median(df, "v", max_exact=500, accuracy=200) == pytest.approx(float(np.median(vals)))
