"""Text forms of values: the rules that turn numbers, variants and bytes into strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROOT = "$"
WHITE_SPACE = " \t\n\r\x0b\x0c"


def col(name: str) -> Column:
    """The column of exactly this name: dots and blanks have no meaning."""
    return F.col("`" + name.replace("`", "``") + "`")


def strip(text: Column) -> Column:
    """Text without white space at either end."""
    return F.trim(text, F.lit(WHITE_SPACE))


def float_text(value: Column) -> Column:
    """Shortest decimal text of a double: positional from 1e-4 up to 1e16, else ``1.5e-05``."""
    text = value.cast("string")
    size = F.abs(value)
    positional = F.rtrim(text.cast("decimal(38,20)").cast("string"), F.lit("0"))
    positional = F.when(positional.endswith("."), F.concat(positional, F.lit("0"))).otherwise(positional)
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    power = F.substring_index(text, "E", -1).try_cast("int")
    scientific = F.concat(
        mantissa, F.when(power < 0, "e-").otherwise("e+"), F.lpad(F.abs(power).cast("string"), 2, "0"))
    return (
        F.when(F.isnan(value), "nan")
        .when(size == float("inf"), F.when(value > 0, "inf").otherwise("-inf"))
        .when(~text.contains("E"), text)
        .when((size >= 1e-4) & (size < 1e16), positional)
        .otherwise(F.when(F.length(F.abs(power).cast("string")) > 2,
                          F.concat(mantissa, F.when(power < 0, "e-").otherwise("e+"), F.abs(power).cast("string")))
                   .otherwise(scientific))
    )


def variant_kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def is_fractional(kind: Column) -> Column:
    # DECIMAL(p,s) or DOUBLE: JSON gives no other kind that begins with D.
    return kind.startswith("D")


def variant_text(value: Column) -> Column:
    """Text of a variant: strings unquoted, objects and arrays as JSON, JSON null as null."""
    # The rules run inside a lambda. Written out per column they would make the generated code of
    # a wide projection too long to be compiled to machine code.
    return F.transform(F.array(value), _variant_text).getItem(0)


def variant_scalar(value: Column) -> Column:
    """Text of a scalar variant; objects and arrays give null."""
    kind = variant_kind(value)
    return (F.when(kind == "STRING", F.try_variant_get(value, ROOT, "string"))
            .when(~(kind.startswith("OBJECT") | kind.startswith("ARRAY")), variant_text(value)))


def _variant_text(value: Column) -> Column:
    number = F.try_variant_get(value, ROOT, "double")
    return (F.when(is_fractional(variant_kind(value)), float_text(number))
            .otherwise(F.try_variant_get(value, ROOT, "string")))


# Fixed value: how a number token comes out of a JSON read as text once it needs an exponent.
EXPONENT_SHAPE = r"^-?\d\.\d+E-?\d{1,3}$"


def leaf_text(text: Column, variant: Column) -> Column:
    """Text of a JSON leaf that was read as text, with ``variant`` as the same leaf's typed value.

    Only text that looks like a rewritten number consults the variant, to tell it from a string.
    """
    rewritten = F.contains(text, F.lit("E")) & text.rlike(EXPONENT_SHAPE)
    return F.when(rewritten, variant_text(variant)).otherwise(text)


def plain_text(value: Column, dtype: T.DataType) -> Column:
    """Text of a value of any type; nested values become JSON."""
    if isinstance(dtype, T.StringType):
        return value
    if isinstance(dtype, T.VariantType):
        return variant_text(value)
    if isinstance(dtype, (T.StructType, T.MapType, T.ArrayType)):
        return F.to_json(value)
    if isinstance(dtype, T.DoubleType):
        return float_text(value)
    return value.cast("string")


def utf8_or_hex(value: Column) -> Column:
    """Bytes as text when they are valid UTF-8, else lower-case hex digits."""
    return F.coalesce(utf8_text(value), F.lower(F.hex(value)))


def utf8_text(value: Column) -> Column:
    """Bytes as text; null when they are not valid UTF-8."""
    return F.try_validate_utf8(value.cast("string"))
