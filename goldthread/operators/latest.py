"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK = "__rank"


def latest_per_key(df: DataFrame, keys: Sequence[str | Column], newest_first: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``newest_first`` order. A null key is a key of its own.

    Give ``newest_first`` a unique last column to make the choice repeatable. Spark cuts every
    input partition to one row per key before the shuffle (window group limit), so a key that
    holds much of the data sends one row per input partition.
    """
    ranked = df.withColumn(RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first)))
    return ranked.filter(F.col(RANK) == 1).drop(RANK)


def newest(*columns: str | Column) -> list[Column]:
    """Descending order with nulls last for each column."""
    return [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in columns]
