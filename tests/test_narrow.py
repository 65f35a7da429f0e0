"""Month matrices stay narrow and tasks even: what a task holds follows
neither the number of months nor the size of the table."""

import math
import re

from unitcast.operators import aggregate as agg
from unitcast.operators.fallback import cold_start_fill
from unitcast.operators.joins import in_tasks
from unitcast.plans import pipelines


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_tasks_follow_the_rows(spark):
    few, many = in_tasks(spark.range(100), ["id"], 100), in_tasks(spark.range(100_000), ["id"], 1000)
    assert few.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert many.rdd.getNumPartitions() == 100


def test_pivot_aggregates_one_value_per_cell(spark):
    rows = [("a", 0, 1.0), ("a", 0, 2.0), ("a", 7, 5.0), ("b", 3, None), ("c", None, 4.0), (None, 2, 6.0), ("d", 1, float("nan"))]
    df = spark.createDataFrame(rows, "k string, m int, v double")
    out = agg.pivot_months(df, ["k"], "m", "v", "sum", range(90))
    assert len(re.findall(r"sum\(", _plan(out))) == 1          # one per month before
    assert out.columns == ["k", *[f"m_{m}" for m in range(90)]]
    got = {r["k"]: r.asDict() for r in out.collect()}
    assert set(got) == {"a", "b", "c", "d", None}
    assert {k: {c: v for c, v in r.items() if c != "k" and v} for k, r in got.items()} == {
        "a": {"m_0": 3.0, "m_7": 5.0}, "b": {}, "c": {}, "d": {}, None: {"m_2": 6.0}}


def test_pivot_without_fill_and_with_other_aggregates(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 0, 2.0), ("b", 2, None), ("b", 5, 3.0)], "k string, m int, v double")
    means = {r["k"]: r for r in agg.pivot_months(df, ["k"], "m", "v", "avg", [0, 2], fill=None).collect()}
    assert (means["a"].m_0, means["a"].m_2, means["b"].m_0, means["b"].m_2) == (1.5, None, None, None)
    counts = {r["k"]: r for r in agg.pivot_months(df, ["k"], "m", "v", "count", fill=None).collect()}
    assert [counts["a"][f"m_{m}"] for m in range(6)] == [2, 0, 0, 0, 0, 0]
    assert [counts["b"][f"m_{m}"] for m in range(6)] == [0, 0, 0, 0, 0, 1]
    nan = spark.createDataFrame([("a", 0, float("nan"))], "k string, m int, v double")
    assert math.isnan(agg.pivot_months(nan, ["k"], "m", "v", "sum", [0], fill=None).first().m_0)


def test_pairs_are_dealt_before_they_are_summed(spark):
    rows = [(m, s, i, float(m + i)) for m in range(4) for s in range(3) for i in range(5) for _ in range(2)]
    sales = spark.createDataFrame(rows, "date_block_num int, shop_id long, item_id long, item_cnt_day double")
    clipped = pipelines.clipped_monthly(sales, 2)
    plan = _plan(clipped)
    assert plan.index("Aggregate") < plan.index("RepartitionByExpression")      # no map in the scan tasks
    want = agg.monthly_sales(sales).filter("date_block_num <= 2")
    assert clipped.exceptAll(want).count() == 0 and clipped.count() == want.count() == 45
    assert pipelines.clipped_monthly(sales, 2, pairs=False).exceptAll(clipped).count() == 0


def test_cold_start_fill_reads_its_predictions_once(spark):
    request = spark.createDataFrame([(0, 1, 1), (1, 1, 2), (2, 2, 1)], "ID long, shop_id long, item_id long")
    preds = spark.createDataFrame([(1, 1, 2.0), (1, 1, 3.0), (2, 2, 4.0)], "shop_id long, item_id long, pred double")
    out = cold_start_fill(request, preds.groupBy("shop_id", "item_id").agg({"pred": "max"}).withColumnRenamed("max(pred)", "pred"))
    assert "max(" not in _plan(out)                             # computed for each use before
    assert {r.ID for r in out.collect()} == {0, 1, 2} and out.filter("ID = 0").first().item_cnt_month == 3.0
