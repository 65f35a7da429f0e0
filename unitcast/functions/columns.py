"""Column-level helpers (all built-in expressions, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from unitcast import config

# Word pattern: runs of two or more letters, digits or underscores, in any
# script (the JVM's ``\w`` is ASCII-only, so the classes are spelled out).
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(c, lo: float = config.CLIP_LO, hi: float = config.CLIP_HI) -> Column:
    """Clip into [lo, hi]; NULL stays NULL (greatest/least skip NULLs)."""
    c = col(c)
    return F.when(c.isNull(), F.lit(None)).otherwise(F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def text_length(c) -> Column:
    """G1: number of characters."""
    return F.length(col(c))


def word_count(c) -> Column:
    """Pieces between single spaces; empty pieces count."""
    return F.size(F.split(col(c), " ", -1))


def first_token(c) -> Column:
    """Text before the first space."""
    return F.split(col(c), " ", -1).getItem(0)


def dash_type(c) -> Column:
    """First '-'-separated piece, trimmed."""
    return F.trim(F.split(col(c), "-", -1).getItem(0))


def dash_subtype(c) -> Column:
    """Second '-'-separated piece trimmed, else the first."""
    parts = F.split(col(c), "-", -1)
    return F.when(F.size(parts) > 1, F.trim(parts.getItem(1))).otherwise(F.trim(parts.getItem(0)))


def tokens(c) -> Column:
    """Lower-cased word tokens of a text (array column)."""
    return F.regexp_extract_all(F.lower(col(c)), F.lit(TOKEN_PATTERN), 0)


def month_label(date_col) -> Column:
    """Date -> 'yyyy-MM'."""
    return F.date_format(col(date_col), "yyyy-MM")


def parse_day_first(c, fmt: str = "dd.MM.yyyy") -> Column:
    """Day-first text date."""
    return F.to_date(col(c), fmt)


def first_truthy(cols: list, mode: str = "reference") -> Column:
    """pick a trend value from lag columns scanned in order.

    ``reference``: the first value that is truthy where a missing value
    (NaN in the reference) counts as truthy and later becomes 0; only an
    exact 0 moves on.  ``first_valid``: first non-null, non-zero value.
    """
    if mode == "first_valid":
        return F.coalesce(*[F.nullif(col(c), F.lit(0.0)) for c in cols], F.lit(0.0))
    if mode != "reference":
        raise ValueError(mode)
    expr = None
    for c in cols:
        c = col(c)
        branch_null, branch_val = c.isNull(), c != 0
        if expr is None:
            expr = F.when(branch_null, F.lit(0.0)).when(branch_val, c)
        else:
            expr = expr.when(branch_null, F.lit(0.0)).when(branch_val, c)
    return expr.otherwise(F.lit(0.0))


def exact_mean(c, scale: int = 10) -> Column:
    """Mean whose sum is exact (decimal), divided once: independent of the
    order in which partial sums are combined, so equal on every run."""
    c = col(c)
    total = F.sum(c.cast(f"decimal(28,{scale})")).cast("double")
    return total / F.nullif(F.count(c), F.lit(0))


def rnd(c, digits: int) -> Column:
    """Round half away from zero at ``digits`` decimals via an integer round of
    the scaled value (same arithmetic as the oracle SQL)."""
    k = float(10 ** digits)
    return F.round(col(c) * k, 0) / k


def exact_sum(c, scale: int = 12) -> Column:
    """Sum in decimal (exact, order-independent), returned as double."""
    return F.sum(col(c).cast(f"decimal(30,{scale})")).cast("double")
