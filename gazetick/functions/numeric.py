"""Small numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip(x: Column, lower: float | None = None, upper: float | None = None) -> Column:
    """Bound ``x``; null stays null (``greatest`` alone would replace it)."""
    out = x
    if lower is not None:
        out = F.greatest(out, F.lit(lower))
    if upper is not None:
        out = F.least(out, F.lit(upper))
    return F.when(x.isNotNull(), out)


def sigmoid(logit: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-logit))


def sigmoid_threshold(logit: Column, threshold: float = 0.5) -> Column:
    return (sigmoid(logit) >= threshold).cast("int")


def finite_or_null(x: Column) -> Column:
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def ratio(a: Column, b: Column) -> Column:
    """a / b; null on a zero divisor. The infinities it stands for are dropped later anyway."""
    return F.try_divide(a, b)


def squared_distance(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two double arrays."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v)
