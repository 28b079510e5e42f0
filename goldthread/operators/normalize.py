"""Bringing rows to a fixed column list or to a target schema."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldthread.functions.casts import to_target
from goldthread.functions.extract import whole_json
from goldthread.functions.formats import DATE_FORMATS, TIMESTAMP_FORMATS
from goldthread.functions.text import col, plain_text, variant_text


TEXT = "__text_"


@dataclass(frozen=True)
class Formats:
    """Date and timestamp formats in ``%`` notation; the first that fits wins."""

    date: Sequence[str] = DATE_FORMATS
    timestamp: Sequence[str] = TIMESTAMP_FORMATS


def normalize_to_schema(
    df: DataFrame, schema: T.StructType, formats: Formats = Formats(), null_text: str | None = "",
) -> DataFrame:
    """Exactly the columns of ``schema``: cast, extra ones dropped, missing ones null.

    Null text becomes ``null_text``, the empty string unless told otherwise.
    """
    ready, casts = _casts(df, schema, formats)

    def column(field: T.StructField):
        value = casts.get(field.name, F.lit(None).cast(field.dataType))
        if isinstance(field.dataType, T.StringType) and null_text is not None:
            value = F.coalesce(value, F.lit(null_text))
        return value.alias(field.name)

    return ready.select(*[column(f) for f in schema.fields])


def cast_present(df: DataFrame, schema: T.StructType, formats: Formats = Formats()) -> DataFrame:
    """Cast the columns that ``schema`` knows and leave the rest as they are."""
    ready, casts = _casts(df, schema, formats)
    return ready.select(*[casts.get(c, col(c)).alias(c) for c in df.columns])


def _casts(df: DataFrame, schema: T.StructType, formats: Formats) -> tuple[DataFrame, dict[str, Column]]:
    """The cast of every column that ``schema`` knows, and the frame they read.

    The text of a VARIANT is a projection of its own: several attempts read it, and it is long.
    """
    source = {f.name: f.dataType for f in df.schema.fields}
    known = [f for f in schema.fields if f.name in source]
    texts = {f.name: f"{TEXT}{f.name}" for f in known
             if isinstance(source[f.name], T.VariantType) and not isinstance(f.dataType, T.StringType)}
    ready = df.withColumns({text: variant_text(col(name)) for name, text in texts.items()})
    casts = {
        f.name: to_target(col(f.name), source[f.name], f.dataType, formats.date, formats.timestamp,
                          col(texts[f.name]) if f.name in texts else None)
        for f in known}
    return ready, casts


def fill_columns(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` and exactly ``columns`` in that order; absent ones are null text."""
    present = set(df.columns)
    return df.select(*keep, *[
        col(c) if c in present else F.lit(None).cast("string").alias(c)
        for c in columns if c not in keep])


def ignore_unknown(df: DataFrame, known: Sequence[str]) -> DataFrame:
    """Only the columns a sink knows, in the sink's order; absent ones are not added."""
    present = set(df.columns)
    return df.select(*[col(c) for c in known if c in present])


def serialize_nested(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, the others untouched."""
    nested = (T.StructType, T.MapType, T.VariantType)
    return df.select(*[
        plain_text(col(f.name), f.dataType).alias(f.name) if isinstance(f.dataType, nested) else col(f.name)
        for f in df.schema.fields])


def parse_json_fields(df: DataFrame, fields: Sequence[str] = ("profiles",)) -> DataFrame:
    """Text columns as VARIANT: the parsed document, or the text itself where it is not valid JSON."""
    return df.withColumns({
        name: F.coalesce(whole_json(col(name)), col(name).cast("variant"))
        for name in fields
        if name in df.columns and isinstance(df.schema[name].dataType, T.StringType)})
