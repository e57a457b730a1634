"""Array-valued vectors without UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    """Vector scaled to length one; null for a null or zero vector."""
    length = norm(a)
    return F.when(length > 0, F.transform(a, lambda x: x.cast("double") / length))


def cosine(a: Column, b: Column, default: float = -1.0) -> Column:
    """Cosine similarity; ``default`` when either vector is unknown or has no length."""
    return F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(float(default)))
