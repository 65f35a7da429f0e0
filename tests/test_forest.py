"""The forest that grows subtrees where their rows are: exact splits, one result however it is cut up."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from unitcast.operators import forest, models


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    n = 3000
    x = rng.normal(size=(n, 3)).round(2)
    c = rng.integers(0, 6, n).astype(float)
    x = np.column_stack([x, c, c * 5 % 6, (c > 3) * 0.5])
    return x, np.clip(np.round(3 * x[:, 0] + c * x[:, 1] + rng.normal(size=n)), -5, 9)


@pytest.fixture(scope="module")
def frame(spark, rows):
    x, y = rows
    return spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, d double, e double, f double, y double").repartition(3).cache()


FEATURES = list("abcdef")


def nodes(model):
    return [t.toDebugString.split("\n", 1)[1] for t in model.stages[-1].trees]


def test_the_trees_do_not_depend_on_where_they_grow(frame, monkeypatch):
    """All levels in one task, or the upper ones in passes over small blocks and the rest in many tasks."""
    fit = lambda: models.fit_forest(frame, FEATURES, "y", num_trees=3, max_depth=7, seed=5)
    monkeypatch.setattr(models, "in_feature_order", lambda df, order, kept=[]: kept[0] if kept else kept.append(df.cache()) or kept[0])
    once = fit()
    monkeypatch.setattr(forest, "TASK_ROWS", 300)
    monkeypatch.setattr(forest, "DEALT_BYTES", 1)
    assert nodes(fit()) == nodes(once)
    monkeypatch.setattr(forest, "CELLS", 700)           # few nodes at a time, no differences to parents
    assert nodes(fit()) == nodes(once)


def test_no_fit_of_the_ml_learner_sees_the_rows(frame, monkeypatch):
    seen = []
    fit = models.RandomForestRegressor.fit
    monkeypatch.setattr(models.RandomForestRegressor, "fit", lambda self, df, *a: seen.append(df.count()) or fit(self, df, *a))
    models.fit_forest(frame, FEATURES, "y", num_trees=2, max_depth=3)
    assert max(seen) == 1                               # only the settings of the model's format


def brute(x, y, splits, depth):
    """Nodes (rows, sum), parents first, by trying every threshold on the plain rows."""
    best = (1e-9, None)
    for f, cuts in enumerate(splits):
        for cut in cuts if depth else ():
            left = x[:, f] <= cut
            if 0 < left.sum() < len(y):
                gain = y.var() - left.mean() * y[left].var() - (~left).mean() * y[~left].var()
                if gain > best[0] + 1e-9:
                    best = (gain, left)
    out = [(len(y), y.sum())]
    for side in () if best[1] is None else (best[1], ~best[1]):
        out += brute(x[side], y[side], splits, depth - 1)
    return out


def test_splits_equal_brute_force(spark, frame, rows):
    x, y = rows
    model = models.fit_forest(frame, FEATURES, "y", num_trees=1, max_depth=4, seed=5, bootstrap=False, maxBins=16)
    splits = [forest.thresholds(c, 16) for c in x.T]
    path = models.config.scratch_path(spark, "brute-forest")
    model.stages[-1].write().overwrite().save(path)
    found = [(int(r.rawCount), r.impurityStats[1]) for r in spark.read.parquet(f"{path}/data").select("nodeData.*").orderBy("id").collect()]
    assert found == [(n, pytest.approx(s)) for n, s in brute(x, y, splits, 4)]


def test_columns_of_joint_values_give_the_histograms_of_their_features(rows):
    x, y = rows
    splits = [forest.thresholds(c, 32) for c in x.T]
    bins = forest.binned(list(x.T), splits)
    groups = forest.joint_columns(bins)
    assert sorted(sum(groups, [])) == list(range(6)) and any({3, 4, 5} <= set(g) for g in groups)
    joint, plain = forest.Layout(splits, groups), forest.Layout(splits, [[f] for f in range(6)])
    node, w = np.arange(len(y)) % 5, (np.arange(len(y)) % 3).astype(float)
    a, b = (forest.Rows(lay, *forest.coded(bins, lay), y).histogram(None, node, w, w * y, 5) for lay in (joint, plain))
    assert all(np.allclose(p, q) for p, q in zip(a, b)) and a[0].sum() == pytest.approx(6 * w.sum())
    many = np.arange(len(y))        # more nodes than rows of a joint value: feature by feature
    a, b = (forest.Rows(lay, *forest.coded(bins, lay), y).histogram(None, many, w, w * y, len(y)) for lay in (joint, plain))
    assert all(np.allclose(p, q) for p, q in zip(a, b))


def test_blocks_of_different_dictionaries_are_joined(rows):
    x, y = rows
    splits = [forest.thresholds(c, 32) for c in x.T]
    bins, layout = forest.binned(list(x.T), splits), forest.Layout(splits, [[0], [1], [2, 3, 4, 5]])
    order = np.argsort(x[:, 3])
    parts = [forest.Rows(layout, *forest.coded(bins[at], layout), y[at]) for at in np.array_split(order, 4)]
    both = forest.Rows.joined(layout, parts)
    for f in range(6):
        assert np.array_equal(both.right(None, np.full(len(y), f), np.full(len(y), 1)), bins[order, f] > 1)
    packed = [forest.Rows.read(layout, p.packed()) for p in parts]
    assert np.array_equal(np.concatenate([p.y for p in packed]), y[order])


def test_missing_values_and_other_rows(spark):
    df = spark.createDataFrame([(1.0, None, 1.0), (2.0, float("nan"), 2.0), (3.0, 4.0, 3.0), (4.0, 5.0, 9.0)] * 5, "a double, b double, y double")
    m = models.fit_forest(df, ["a", "b"], "y", num_trees=1, max_depth=4, bootstrap=False)
    assert [r.prediction for r in m.transform(df).orderBy("a").select("prediction").distinct().orderBy("prediction").collect()] == [1.0, 2.0, 3.0, 9.0]
    one = models.fit_forest(df.filter("a = 3"), ["a", "b"], "y", num_trees=2, max_depth=4)
    assert one.stages[-1].totalNumNodes == 2 and one.transform(df).select("prediction").distinct().collect()[0][0] == 3.0
    with pytest.raises(ValueError):
        models.fit_forest(df.filter("a > 9"), ["a", "b"], "y")


def test_in_sample_rows_are_scored_as_by_the_pipeline(frame):
    m = models.fit_forest(frame, FEATURES, "y", num_trees=3, max_depth=5)
    own = models.in_sample(m, frame, FEATURES, "y")
    both = [df.groupBy("y", "prediction").count() for df in (own, m.transform(frame).select("y", "prediction"))]
    assert own.columns == ["y", "prediction"] and both[0].exceptAll(both[1]).count() == 0 and own.count() == frame.count()


def test_pages_of_stored_blocks_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    """A row is a block here: the writer may not gather a hundred of them before it looks at their size."""
    import pyarrow.parquet as pq
    from unitcast.operators import joins
    monkeypatch.setattr(joins.config, "scratch_path", lambda s, name: str(tmp_path / name))
    df = spark.range(0, 90, 1, 1).select(F.expr("sha2(string(id), 256)").alias("h")).select(F.expr("cast(repeat(h, 8000) as binary)").alias("b"))
    joins.materialize(df, compression="none", **forest.LARGE_ROWS)
    found = [pq.ParquetFile(p).metadata.num_row_groups for p in tmp_path.glob("*/*.parquet")]
    assert max(found) >= 2          # 46 MB in groups of 16 MB
