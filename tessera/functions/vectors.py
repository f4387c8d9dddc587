"""Vector functions on arrays of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine_similarity(a: Column, b: Column) -> Column:
    """0 where either vector has no length."""
    length = norm(a) * norm(b)
    return F.when(length == 0, F.lit(0.0)).otherwise(dot(a, b) / length)


def unit(a: Column) -> Column:
    """The vector at length 1; one without length as it is."""
    return F.transform(a, lambda x: F.when(norm(a) == 0, x).otherwise(x / norm(a)))
