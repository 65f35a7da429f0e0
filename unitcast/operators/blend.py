"""Blend of stored predictions (A8): non-negative least squares on the holdout
split, applied to the request split.

The store holds (split, model, keys, prediction).  One aggregate turns it into
a row per split and key with a column per model, one Gram aggregate over the
holdout rows gives weights and error, and the request rows are scored with
them.  A key that a model does not know counts as 0 for that model.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from unitcast.operators import gram

HOLDOUT, REQUEST = "holdout", "request"


@dataclass
class Blend:
    weights: dict[str, float]
    rows: int
    rmse: float | None


def by_model(store: DataFrame, models: list[str], keys: list[str], missing: float = 0.0) -> DataFrame:
    """One row per split and key, one column per model (map-side combined; the
    split is part of the exchange key)."""
    cells = [F.coalesce(F.max(F.when(F.col("model") == m, F.col("prediction"))), F.lit(missing)).alias(m) for m in models]
    return store.groupBy("split", *keys).agg(*cells)


def fit_blend(store: DataFrame, truth: DataFrame, models: list[str], keys: list[str], label: str) -> Blend:
    """Weights from the rows of ``truth`` (keys, label); a row that no model
    predicted counts with zeros."""
    held = by_model(store.filter(F.col("split") == HOLDOUT), models, keys).drop("split")
    rows = truth.select(*keys, label).join(held, keys, "left").fillna(0.0, models)
    sums = gram.fit_gram(rows, models, label, intercept=False)
    weights = gram.non_negative(sums)
    return Blend(weights, sums.rows, math.sqrt(gram.squared_error(sums, weights) / sums.rows) if sums.rows else None)


def blended(store: DataFrame, blend: Blend, keys: list[str], split: str = REQUEST) -> DataFrame:
    """(keys, prediction) of a split."""
    models = list(blend.weights)
    return by_model(store.filter(F.col("split") == split), models, keys).select(*keys, gram.linear(blend.weights).alias("prediction"))
