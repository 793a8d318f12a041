"""Rows from computed arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def elements(
    df: DataFrame, keep: list[str], array: Column | str, position: str, element: str
) -> DataFrame:
    """``keep`` columns with one row per element of an array, and its position.

    For an inner generator Spark adds a filter that the array is not empty, and pushing it
    below the projection that computes the array computes it twice more. The outer
    generator has no such filter; rows without elements are dropped after it.
    """
    return df.select(
        *keep, F.posexplode_outer(array).alias(position, element)
    ).where(F.col(position).isNotNull())
