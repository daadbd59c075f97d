"""Numeric expressions shared by operators and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DECIMALS = 6


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def r6(col, decimals: int = DECIMALS) -> Column:
    """Round to a fixed number of decimals; ``+ 0.0`` folds ``-0.0`` into ``0.0``."""
    return F.round(_c(col).cast("double"), decimals) + F.lit(0.0)


def safe_ratio(num, den, default: float = 0.0) -> Column:
    """``num / den`` if ``den > 0`` else ``default``."""
    return F.when(_c(den) > 0, _c(num).cast("double") / _c(den)).otherwise(F.lit(default))


def log_discount(pos) -> Column:
    """DCG discount ``1 / log2(pos + 1)`` for a 1-based position."""
    return F.lit(1.0) / F.log2(_c(pos).cast("double") + F.lit(1.0))


def ideal_dcg(n) -> Column:
    """``sum_{i=1..n} 1/log2(i+1)`` (0 for ``n <= 0``); n is at most K."""
    return F.aggregate(
        F.sequence(F.lit(1), F.greatest(_c(n).cast("int"), F.lit(0))),
        F.lit(0.0),
        lambda acc, i: acc + F.lit(1.0) / F.log2(i.cast("double") + F.lit(1.0)),
    )


def l2_norm(vec) -> Column:
    """Euclidean norm of an array<double> column."""
    return F.sqrt(F.aggregate(_c(vec), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def l2_normalize(vec, eps: float = 1e-8) -> Column:
    """``v / (||v|| + eps)`` — the epsilon-guarded normalisation."""
    n = l2_norm(vec)
    return F.transform(_c(vec), lambda x: x.cast("double") / (n + F.lit(eps)))
