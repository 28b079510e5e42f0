"""Change records and upserts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldthread.functions.text import col
from goldthread.operators.latest import latest_per_key, newest
from goldthread.operators.sizing import fits

CHANGE_TYPE = "_CHANGE_TYPE"  # fixed value
CHANGED = "__changed_"


def change_records(df: DataFrame, change_type: str = "UPSERT", at: Column | None = None) -> DataFrame:
    """Rows as ``record`` (with the change type) and ``row_mutation_info``."""
    stamp = F.date_format(F.current_timestamp() if at is None else at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return df.select(
        F.struct("*", F.lit(change_type).alias(CHANGE_TYPE)).alias("record"),
        F.struct(F.lit(change_type).alias("change_type"), stamp.alias("timestamp")).alias("row_mutation_info"))


def apply_changes(
    current: DataFrame,
    changes: DataFrame,
    pk: Sequence[str],
    order: Sequence[str],
    broadcast_rows: int | None = None,
) -> DataFrame:
    """``current`` after the changes: the newest change of a key replaces its row or deletes it.

    ``changes`` has the columns of ``current``, ``_CHANGE_TYPE`` (UPSERT or DELETE) and ``order``,
    the columns that tell which change is newer. Only the changes are ranked. Rows without a change
    pass an anti join; with ``broadcast_rows`` the changed keys are counted and, when they are that
    few, broadcast, so that the table itself is not shuffled.
    """
    return apply_latest(current, latest_changes(changes, pk, order), pk, broadcast_rows)


def latest_changes(changes: DataFrame, pk: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest change of every key."""
    return latest_per_key(changes, list(pk), newest(*order))


def apply_latest(
    current: DataFrame, latest: DataFrame, pk: Sequence[str], broadcast_rows: int | None = None,
) -> DataFrame:
    """``apply_changes`` for changes with one row per key. They are read up to three times: persist them."""
    keys = latest.select(*[col(c).alias(f"{CHANGED}{c}") for c in pk])
    if broadcast_rows is not None and fits(keys, broadcast_rows):
        keys = F.broadcast(keys)
    same_key = reduce(and_, [col(c).eqNullSafe(col(f"{CHANGED}{c}")) for c in pk])
    untouched = current.join(keys, same_key, "left_anti")
    written = latest.filter(F.col(CHANGE_TYPE) != "DELETE").select(*[col(c) for c in current.columns])
    return untouched.unionByName(written)
