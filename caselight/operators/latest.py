"""Newest rows: per key and overall."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_RANK = "__row_number"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key under ``order``.

    Spark limits each key to one row inside every map task before the shuffle (a partial window-group limit), so a key
    with a third of all rows sends one row per task, not its rows.
    """
    ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(_RANK, ranked).where(F.col(_RANK) == 1).drop(_RANK)


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows of each key with their position; limited per map task before the shuffle as above."""
    ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(rank, ranked).where(F.col(rank) <= k)


def newest(df: DataFrame, order: Sequence[Column], n: int = 1) -> DataFrame:
    """First ``n`` rows overall: each task keeps n rows and the driver merges those (no global sort)."""
    return df.orderBy(*order).limit(n)
