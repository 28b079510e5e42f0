"""Choosing the new or the old value of every column."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldthread.functions.text import plain_text
from goldthread.operators.keyed import drop_null_keys
from goldthread.operators.latest import latest_per_key, newest
from goldthread.operators.mapping import MappingRow

OLD_EXISTS = "__old_exists"


def reconcile(
    new: DataFrame,
    old: DataFrame,
    mapping: Iterable[MappingRow],
    pk: str,
    flag: str = "reconcile",
    new_order: Sequence[str | Column] = (),
    old_order: Sequence[str | Column] = (),
) -> DataFrame:
    """One output row per key of ``new``.

    Of several rows for a key the first of each side counts: the greatest in ``new_order`` or ``old_order``, then that with
    the greatest hash, so the choice does not change from run to run. ``flag`` names the mapping flag that decides:
    ``reconcile`` the retrieved one, ``original`` the confirmed one. It need not be the one by which the new rows were
    mapped. With the flag on, a column of ``new`` wins even where it is null; with the flag off the old
    row wins wherever there is one. Which columns a side has is known from its schema, so only
    "is there an old row" is decided per row. Keys found only in ``old`` are dropped, and the key
    column is always the new key unless it is blank or zero.
    """
    _check_key(new, old, pk)
    first_new = latest_per_key(drop_null_keys(new, pk), [pk], newest(*new_order, row_hash(new)))
    first_old = latest_per_key(old, [pk], newest(*old_order, row_hash(old)))
    return choose_values(first_new, first_old, mapping, pk, flag)


def _check_key(new: DataFrame, old: DataFrame, pk: str) -> None:
    for side, df in (("new", new), ("old", old)):
        if pk not in df.columns:
            raise ValueError(f"the {side} rows have no column {pk}")


def row_hash(df: DataFrame) -> Column:
    """A last sort column: rows that differ are told apart. Maps and VARIANTs cannot be hashed and are left out."""
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.xxhash64(*[F.col(f"`{c.replace('`', '``')}`") for c in plain]) if plain else F.lit(0)


def choose_values(
    new: DataFrame, old: DataFrame, mapping: Iterable[MappingRow], pk: str, flag: str = "reconcile",
) -> DataFrame:
    """``reconcile`` for sides with one row per key, the new keys not null."""
    _check_key(new, old, pk)
    new_types, old_types = dict(_typed(new)), dict(_typed(old))
    joined = new.alias("n").join(
        old.withColumn(OLD_EXISTS, F.lit(True)).alias("o"), _cell("n", pk) == _cell("o", pk), "left")

    chosen: dict[str, Column] = {}
    for row in mapping:
        name = row.dest
        in_new, in_old = name in new_types, name in old_types
        if in_new and (row.applies(flag) or not in_old):
            chosen[name] = _cell("n", name)
        elif in_old and (row.applies(flag) or not in_new):
            chosen[name] = _cell("o", name)
        elif in_new and in_old:
            old_value, new_value = _cell("o", name), _cell("n", name)
            if old_types[name] != new_types[name]:
                old_value = plain_text(old_value, old_types[name])
                new_value = plain_text(new_value, new_types[name])
            chosen[name] = F.when(F.col(f"o.{OLD_EXISTS}"), old_value).otherwise(new_value)
    key = _cell("n", pk)
    key_type = new_types[pk]
    truthy = key != ("" if isinstance(key_type, T.StringType) else F.lit(0).cast(key_type))
    chosen[pk] = F.when(truthy, key).otherwise(chosen.get(pk, F.lit(None)).cast(key_type))
    return joined.select(*[value.alias(name) for name, value in chosen.items()])


def _typed(df: DataFrame):
    return ((f.name, f.dataType) for f in df.schema.fields)


def _cell(side: str, name: str) -> Column:
    return F.col(f"{side}.`{name.replace('`', '``')}`")
