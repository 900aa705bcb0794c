"""Expressions over ``ARRAY<FLOAT>`` vectors, for pairs of columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 when a vector is zero, NULL when one is missing or the lengths differ."""
    value = F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0))
    return F.when(a.isNotNull() & b.isNotNull() & (F.size(a) == F.size(b)), value)


def euclidean(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x - y).cast("double") * (x - y).cast("double"))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))
