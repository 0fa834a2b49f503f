"""Similarity of numeric arrays, evaluated in double precision."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def vector(values: Sequence[float] | Column | str) -> Column:
    if isinstance(values, Column):
        return values.cast("array<double>")
    if isinstance(values, str):
        return F.col(values).cast("array<double>")
    return F.lit([float(v) for v in values])


def _sum(c: Column) -> Column:
    return F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x)


def dot(a, b) -> Column:
    return _sum(F.zip_with(vector(a), vector(b), lambda x, y: x * y))


def norm(a) -> Column:
    return F.sqrt(_sum(F.transform(vector(a), lambda x: x * x)))


def cosine(a, b) -> Column:
    """0 for null, empty, zero or differently sized vectors."""
    va, vb = vector(a), vector(b)
    comparable = (F.size(va) > 0) & (F.size(va) == F.size(vb))
    scale = norm(va) * norm(vb)
    return F.when(comparable & (scale > 0), F.coalesce(dot(va, vb) / scale, F.lit(0.0))).otherwise(0.0)


def l2(a, b) -> Column:
    """Euclidean distance; null unless both vectors have the same size."""
    va, vb = vector(a), vector(b)
    squares = _sum(F.zip_with(va, vb, lambda x, y: (x - y) * (x - y)))
    return F.when(F.size(va) == F.size(vb), F.sqrt(squares))
