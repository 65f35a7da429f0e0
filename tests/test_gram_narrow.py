"""The Gram sums are one narrow aggregate, however many terms there are."""

import re

from pyspark.sql import functions as F

from unitcast.operators import gram


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_gram_is_one_narrow_aggregate(spark):
    rows = [(1.0, 0.0, 2.0), (0.0, 0.0, 0.0), (-1.5, 2.0, 0.5), (None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    sums = gram.gram_sums(df, ["a", "b"], "y")
    assert len(re.findall(r"sum\(", _plan(sums))) == 1         # one per pair of terms before
    r = sums.first()
    assert r["rows"] == 3 and (r.s_0_0, r.s_0_1, r.s_0_2, r.s_1_1, r.s_1_2, r.s_2_2) == (3.0, -0.5, 2.0, 3.25, -3.0, 4.0)
    assert (r.t_0, r.t_1, r.t_2, r.yy) == (2.5, 1.25, 1.0, 4.25)
    empty = gram.gram_sums(df.filter("a > 5"), ["a", "b"], "y").first()
    assert empty["rows"] == 0 and empty.s_0_0 is None and empty.yy is None
    assert gram.gram_sums(df, ["a"], "b", intercept=False).columns == ["rows", "s_0_0", "t_0", "yy"]
    assert gram.fit_gram(df.withColumn("n", F.lit(0.0)), ["n"], "y").xtx.tolist() == [[4.0, 0.0], [0.0, 0.0]]
