"""Least squares from one aggregate: the Gram sums XᵀX and Xᵀy.

Every task adds up its rows' products; one row of (p + 1)(p + 2) / 2 + p + 2
sums comes back, whatever the number of rows.  The solve is a matter of p + 1
numbers.  Sums are exact decimals by default, so neither the order of partial
sums nor the number of partitions changes a coefficient.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from unitcast.functions.columns import exact_sum

INTERCEPT = "intercept"
LABEL = "label"


@dataclass
class Gram:
    """Sums over ``rows`` rows without nulls: ``xtx`` (terms x terms), ``xty`` and ``yty``."""
    terms: list[str]
    rows: int
    xtx: np.ndarray
    xty: np.ndarray
    yty: float


def _terms(features: list[str], intercept: bool) -> list[tuple[str, Column]]:
    return [(INTERCEPT, F.lit(1.0))] * intercept + [(f, F.col(f"`{f}`").cast("double")) for f in features]


def complete(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Rows without a null or NaN in the used columns (a product with one has no value)."""
    used = [F.col(f"`{c}`").cast("double") for c in [*features, label]]
    return df.filter(F.forall(F.array(*used), lambda v: v.isNotNull() & ~F.isnan(v)))


def gram_sums(df: DataFrame, features: list[str], label: str, intercept: bool = True, exact: bool = True) -> DataFrame:
    """The sums as a one-row frame: ``rows``, ``s_i_j`` (i <= j), ``t_i`` and ``yy``.

    A row gives its products that are not 0 (the others add nothing) and one
    entry for the row itself, all summed by one narrow aggregate: a plan of an
    exact sum per pair of terms is too large a function to be compiled."""
    add = exact_sum if exact else F.sum
    y = len(_terms(features, intercept))
    values = [*[c for _, c in _terms(features, intercept)], F.col(f"`{label}`").cast("double")]
    held = F.filter(F.array(*[F.struct(F.lit(i).alias("i"), c.alias("v")) for i, c in enumerate(values)]), lambda t: t["v"] != 0)

    def products(a: Column) -> Column:
        return F.transform(F.filter("_held", lambda b: b["i"] >= a["i"]), lambda b: F.struct(
            a["i"].alias("i"), b["i"].alias("j"), (a["v"] * b["v"]).alias("v")))

    row = F.array(F.struct(F.lit(-1).alias("i"), F.lit(-1).alias("j"), F.lit(1.0).alias("v")))
    cells = complete(df, features, label).select(held.alias("_held"))
    cells = cells.select(F.explode(F.concat(row, F.flatten(F.transform("_held", products)))).alias("_c"))
    sums = cells.groupBy("_c.i", "_c.j").agg(add("_c.v").alias("v"))
    rows = F.coalesce(F.max(F.when(F.col("i") == -1, F.col("v"))), F.lit(0.0)).cast("long")
    found = sums.agg(rows.alias("rows"), F.map_from_entries(F.collect_list(
        F.struct(F.concat_ws("_", "i", "j").alias("k"), "v"))).alias("_v"))

    def cell(i: int, j: int) -> Column:
        return F.when(F.col("rows") > 0, F.coalesce(F.col("_v")[f"{i}_{j}"], F.lit(0.0)))

    return found.select("rows", *[cell(i, j).alias(f"s_{i}_{j}") for i in range(y) for j in range(i, y)],
                        *[cell(i, y).alias(f"t_{i}") for i in range(y)], cell(y, y).alias("yy"))


def gram_long(df: DataFrame, features: list[str], label: str, intercept: bool = True) -> DataFrame:
    """The sums as rows (term, other, value); the label's products come as ``label``."""
    terms = [t for t, _ in _terms(features, intercept)]
    cells = [(a, b, f"s_{i}_{j}") for i, a in enumerate(terms) for j, b in enumerate(terms) if i <= j]
    cells += [(a, LABEL, f"t_{i}") for i, a in enumerate(terms)] + [(LABEL, LABEL, "yy")]
    row = gram_sums(df, features, label, intercept)
    rows = F.array(*[F.struct(F.lit(a).alias("term"), F.lit(b).alias("other"), F.coalesce(F.col(c), F.lit(0.0)).alias("value"))
                     for a, b, c in cells])
    return row.select(F.explode(rows).alias("c")).select("c.term", "c.other", "c.value")


def fit_gram(df: DataFrame, features: list[str], label: str, intercept: bool = True, exact: bool = True) -> Gram:
    """The sums on the driver (a few numbers)."""
    r, terms = gram_sums(df, features, label, intercept, exact).first(), [t for t, _ in _terms(features, intercept)]
    n = len(terms)
    xtx = np.array([[r[f"s_{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(n)] for i in range(n)], dtype=float).reshape(n, n)
    return Gram(terms, r["rows"], xtx, np.array([r[f"t_{i}"] or 0.0 for i in range(n)], dtype=float), r["yy"] or 0.0)


def _scaled(g: Gram) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of columns scaled to unit length: the solve does not depend on units."""
    scale = np.sqrt(np.where(np.diag(g.xtx) > 0, np.diag(g.xtx), 1.0))
    return g.xtx / np.outer(scale, scale), g.xty / scale, scale


def least_squares(g: Gram) -> dict[str, float]:
    """Coefficients that minimise the squared error; of several (collinear or
    constant features) the shortest for unit columns."""
    a, b, scale = _scaled(g)
    solved = np.linalg.lstsq(a, b, rcond=1e-12)[0] if len(b) else b
    return dict(zip(g.terms, (solved / scale).tolist()))


def non_negative(g: Gram, tolerance: float = 1e-12) -> dict[str, float]:
    """Non-negative least squares by active sets: the term with the steepest
    descent enters, terms that would turn negative leave again."""
    a, b, scale = _scaled(g)
    n = len(b)
    x, active = np.zeros(n), np.zeros(n, dtype=bool)
    for _ in range(3 * n + 3):
        slope = np.where(active, -np.inf, b - a @ x)
        if not n or slope.max() <= tolerance:
            break
        active[slope.argmax()] = True
        while active.any():
            trial = np.zeros(n)
            trial[active] = np.linalg.lstsq(a[np.ix_(active, active)], b[active], rcond=1e-12)[0]
            if (trial[active] > 0).all():
                x = trial
                break
            falling = active & (trial <= 0)
            step = np.min(x[falling] / (x[falling] - trial[falling]), initial=1.0, where=(x - trial)[falling] > 0)
            x = x + step * (trial - x)
            active &= x > tolerance
            x[~active] = 0.0
    return dict(zip(g.terms, (x / scale).tolist()))


def linear(weights: dict[str, float]) -> Column:
    """The fitted value as a column; null if a feature is."""
    out = F.lit(float(weights.get(INTERCEPT, 0.0)))
    for term, w in weights.items():
        if term != INTERCEPT:
            out = out + F.col(f"`{term}`").cast("double") * F.lit(float(w))
    return out


def squared_error(g: Gram, weights: dict[str, float]) -> float:
    """Sum of squared errors of any weights, from the sums alone."""
    w = np.array([weights[t] for t in g.terms])
    return max(0.0, float(g.yty - 2 * w @ g.xty + w @ g.xtx @ w))


def normal_equations(df: DataFrame, features: list[str], label: str, weights: dict[str, float]) -> DataFrame:
    """(term, xty, xtxb): both sides of XᵀX b = Xᵀy, each summed over the rows.
    They agree, and the residuals are orthogonal to every feature, if and only
    if ``weights`` are the least squares."""
    terms = _terms(features, INTERCEPT in weights)
    y, fitted = F.col(f"`{label}`").cast("double"), linear(weights)
    row = complete(df, features, label).agg(*[F.sum(x * y).alias(f"y_{i}") for i, (_, x) in enumerate(terms)],
                                            *[F.sum(x * fitted).alias(f"b_{i}") for i, (_, x) in enumerate(terms)])
    rows = F.array(*[F.struct(F.lit(t).alias("term"), F.col(f"y_{i}").alias("xty"), F.col(f"b_{i}").alias("xtxb"))
                     for i, (t, _) in enumerate(terms)])
    return row.select(F.explode(rows).alias("c")).select("c.term", "c.xty", "c.xtxb")
