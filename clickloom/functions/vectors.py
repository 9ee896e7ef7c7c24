"""Array-as-vector expressions, evaluated in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: str | Column, b: str | Column) -> Column:
    left = F.col(a) if isinstance(a, str) else a
    right = F.col(b) if isinstance(b, str) else b
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def linear_combination(vector: str | Column, weights: list[list[float]]) -> Column:
    """``vector @ weights`` with a small constant matrix, as an array."""
    v = F.col(vector) if isinstance(vector, str) else vector
    columns = list(zip(*weights))
    return F.array(*[dot(v, F.array(*[F.lit(float(x)) for x in col])) for col in columns])
