"""Operators on rows with a key."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_null_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows with a key. The empty string is a key."""
    return df.filter(F.col(key).isNotNull())


def cogroup_rows(inputs: Mapping[str, DataFrame], key: str) -> DataFrame:
    """The rows of all inputs, one output row each: key, ``alias`` of the input, one struct per alias.

    A group is the set of rows that share a key. It is never gathered into one list, so a group
    may be larger than the memory of a task.
    """
    tagged = [
        drop_null_keys(df, key).select(key, F.lit(alias).alias("alias"), F.struct("*").alias(alias))
        for alias, df in inputs.items()]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), tagged)


def cogroup_counts(inputs: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Number of rows per key and input, ``n_<alias>``; zero where an input lacks the key."""
    tagged = [
        drop_null_keys(df, key).select(
            key, *[F.lit(1 if other == alias else 0).cast("bigint").alias(f"n_{other}") for other in inputs])
        for alias, df in inputs.items()]
    union = reduce(DataFrame.unionByName, tagged)
    return union.groupBy(key).agg(*[F.sum(f"n_{alias}").alias(f"n_{alias}") for alias in inputs])
