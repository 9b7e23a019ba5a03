"""Dense vector columns (``array<float>``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a, b) -> Column:
    """Inner product, accumulated in double."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)


def unit(a) -> Column:
    """L2-normalised copy; a zero vector is returned unchanged."""
    norm = F.sqrt(dot(a, a))
    return F.when(norm > 0, F.transform(a, lambda x: (x / norm).cast("float"))).otherwise(a)
