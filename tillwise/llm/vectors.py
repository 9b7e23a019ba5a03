"""Blocks of vectors: what the embedding operators share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: str) -> Column:
    """Whether a vector is there, not empty, and all its components are finite numbers."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    return F.coalesce(ok & (F.size(vector) > 0), F.lit(False))


def pack(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


def matrix(blob: bytes, rows: int) -> np.ndarray:
    a = np.frombuffer(blob)
    return a.reshape(rows, len(a) // rows)


def dense(vectors, width: int) -> np.ndarray:
    """Rows of doubles; a vector shorter than ``width`` ends in zeros."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def width_of(df: DataFrame, vector: str) -> int:
    """The longest vector's length."""
    return df.agg(F.max(F.size(vector))).first()[0] or 0
