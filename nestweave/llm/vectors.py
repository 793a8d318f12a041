"""Embedding vectors as integers, in tables and in batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a component is multiplied with before it is rounded down.
SCALE = 256


def is_whole(vector: str) -> Column:
    """Whether the vector and all its components are there and finite."""
    return F.col(vector).isNotNull() & F.forall(
        vector, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False))
    )


def as_integers(vector: str, scale: int = SCALE) -> Column:
    """``floor(scale * c)`` of every component ``c`` as double, array of long."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * scale).cast("long"))


def common_length(rows: DataFrame, vector: str) -> int | None:
    """The length of all vectors, None if there are none; different lengths are an error."""
    low, high = rows.agg(F.min(F.size(vector)), F.max(F.size(vector))).first()
    if low != high:
        raise ValueError(f"vectors have from {low} to {high} components")
    return low


def matrix(vectors: pa.Array, length: int) -> np.ndarray:
    """A batch of vectors of one length as rows of int64."""
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(vectors), length)
