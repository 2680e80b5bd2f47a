"""Ordered limits: first n, first n per group, latest change per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """First ``n`` rows; each task keeps n candidates, so nothing is sorted as a whole."""
    return df.orderBy(*order).limit(n)


def limit_per_group(df: DataFrame, groups: Sequence[str], order: Sequence[Column | str], n: int) -> DataFrame:
    """First ``n`` rows of every group.

    The rank filter is applied inside each input task before the shuffle and again after it, so a
    hot group sends n rows per task.
    """
    window = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= n).drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key by ``order`` (all descending). Give a unique last column to settle ties."""
    return limit_per_group(df, keys, [F.col(c).desc() for c in order], 1)
