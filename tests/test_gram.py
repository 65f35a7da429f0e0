"""Gram sums, least squares, non-negative least squares and blends."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from unitcast.operators import blend, gram, models

FEATURES = ["a", "b", "c"]


def frame(spark, rows):
    return spark.createDataFrame([tuple(map(float, r)) for r in rows], "a double, b double, c double, y double").repartition(5)


def made(seed, n=400):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 21, (n, 3)) * [1, 10, 0.25]
    return np.column_stack([x, 3 + x @ [0.5, -0.2, 1.5] + rng.normal(0, 2, n)])


def test_equals_linear_regression(spark):
    df = frame(spark, made(1))
    got = gram.least_squares(gram.fit_gram(df, FEATURES, "y"))
    fitted = models.fit_linear(df, FEATURES, "y").stages[-1]
    assert got["intercept"] == pytest.approx(fitted.intercept, abs=1e-8)
    assert [got[f] for f in FEATURES] == pytest.approx(list(fitted.coefficients), abs=1e-8)
    sides = gram.normal_equations(df, FEATURES, "y", got).collect()
    assert all(r.xty == pytest.approx(r.xtxb, rel=1e-9) for r in sides) and len(sides) == 4
    other = {**got, "b": got["b"] + 0.01}       # any other weights break them
    assert any(abs(r.xty - r.xtxb) > 1 for r in gram.normal_equations(df, FEATURES, "y", other).collect())
    error = df.agg(F.sum(F.pow(F.col("y") - gram.linear(got), 2))).first()[0]
    assert gram.squared_error(gram.fit_gram(df, FEATURES, "y"), got) == pytest.approx(error, rel=1e-6)


def test_sums_do_not_depend_on_partitions(spark):
    rows = made(2)
    one = gram.gram_long(frame(spark, rows).coalesce(1), FEATURES, "y").collect()
    many = gram.gram_long(frame(spark, rows[::-1]).repartition(37), FEATURES, "y").collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many)) and len(one) == 10 + 4 + 1


def test_nulls_empty_and_collinear(spark):
    rows = [(1.0, 2.0, None, 1.0), (None, 1.0, 1.0, 1.0), (1.0, 1.0, 1.0, None), (float("nan"), 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double")
    empty = gram.fit_gram(df, FEATURES, "y")
    assert empty.rows == 0 and gram.least_squares(empty) == {"intercept": 0.0, "a": 0.0, "b": 0.0, "c": 0.0}
    assert gram.non_negative(empty) == gram.least_squares(empty)
    same = frame(spark, [(k, 2 * k, 5, 4 * k + 1) for k in range(20)])      # b twice a, c constant
    got = gram.least_squares(gram.fit_gram(same, FEATURES, "y"))
    fitted = same.select((gram.linear(got) - F.col("y")).alias("e")).collect()
    assert max(abs(r.e) for r in fitted) < 1e-6


@pytest.mark.parametrize("seed", range(6))
def test_non_negative_equals_all_active_sets(seed):
    rng = np.random.default_rng(seed)
    x, y = rng.normal(0, 1, (50, 4)), rng.normal(0, 1, 50)
    g = gram.Gram(list("pqrs"), 50, x.T @ x, x.T @ y, float(y @ y))
    best = y @ y
    for k in range(1, 5):
        for held in itertools.combinations(range(4), k):
            w = np.linalg.lstsq(x[:, held], y, rcond=None)[0]
            if (w >= 0).all():
                best = min(best, ((y - x[:, held] @ w) ** 2).sum())
    got = gram.non_negative(g)
    assert min(got.values()) >= 0 and gram.squared_error(g, got) == pytest.approx(best, rel=1e-9)


def test_blend_of_stored_predictions(spark):
    rng = np.random.default_rng(3)
    good, bad, truth = rng.uniform(0, 20, 300), rng.uniform(0, 20, 300), []
    rows = []
    for i in range(300):
        rows += [("holdout", "good", i, float(good[i])), ("request", "good", i, float(good[i]) + 1)]
        if i % 2:       # a model that knows half of the keys
            rows += [("holdout", "bad", i, float(bad[i])), ("request", "bad", i, float(bad[i]))]
        truth.append((i, float(0.9 * good[i])))
    store = spark.createDataFrame(rows, "split string, model string, key long, prediction double").repartition(4)
    labels = spark.createDataFrame([*truth, (999, 0.0)], "key long, units double")      # 999: no model knows it
    found = blend.fit_blend(store, labels, ["good", "bad"], ["key"], "units")
    assert found.rows == 301 and found.weights["good"] == pytest.approx(0.9) and found.weights["bad"] == pytest.approx(0, abs=1e-9)
    assert found.rmse == pytest.approx(0, abs=1e-5)
    out = {r.key: r.prediction for r in blend.blended(store, found, ["key"]).collect()}
    assert len(out) == 300 and out[7] == pytest.approx(0.9 * (good[7] + 1))
    none = blend.fit_blend(store.limit(0), labels.limit(0), ["good", "bad"], ["key"], "units")
    assert none.rows == 0 and none.rmse is None and not math.isnan(none.weights["good"])
