"""Dense-vector expressions over ``ARRAY<DOUBLE>`` columns (higher-order functions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sq_distance(a, b) -> Column:
    """Squared L2 distance between two equal-length arrays."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: (x - y) * (x - y)),
                       F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def l2_distance(a, b) -> Column:
    return F.sqrt(sq_distance(a, b))


def standardize(x, mean, std) -> Column:
    """(x - mean) / std element-wise; ``std`` already has zeros mapped to 1."""
    return F.zip_with(F.zip_with(_c(x), _c(mean), lambda v, m: v - m), _c(std),
                      lambda d, s: d / s)


def argmax(p) -> Column:
    """0-based index of the largest value, first index wins ties."""
    return (F.array_position(_c(p), F.array_max(_c(p))) - 1).cast("int")
