"""Casts to the target types. A value that does not fit becomes null and never fails the row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldthread.functions.formats import (
    DATE_FORMATS, TIMESTAMP_FORMATS, compile_format, parse_first, single_blanks)
from goldthread.functions.text import ROOT, is_fractional, plain_text, strip, variant_kind

# Fixed values.
TRUE_WORDS = ("true", "1", "yes")
EPOCH_SECONDS_MAX_LENGTH = 10
# Number text: no type suffix, no hexadecimal.
FLOAT_SHAPE = r"^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"
WHOLE_SHAPE = r"^[+-]?\d+$"
# At most 19 digits that count: more never fit 64 bits.
PADDED_WHOLE_SHAPE = r"^\s*[+-]?0*\d{1,19}\s*$"
# Seconds of 0001-01-01 and of 9999-12-31 23:59:59.
FIRST_SECOND, LAST_SECOND = -62135596800, 253402300799

NUMBERS = (T.FloatType, T.DoubleType, T.DecimalType)
WHOLE_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
INSTANTS = (T.TimestampType, T.TimestampNTZType)


def to_target(
    value: Column,
    source: T.DataType,
    target: T.DataType,
    date_formats: Sequence[str] = DATE_FORMATS,
    timestamp_formats: Sequence[str] = TIMESTAMP_FORMATS,
    text: Column | None = None,
) -> Column:
    """``value`` of type ``source`` as the target column type; null text stays null.

    ``text`` may give the value's text where a column already holds it.
    """
    if text is None:
        text = plain_text(value, source)
    if isinstance(target, T.StringType):
        return text
    if isinstance(target, T.DateType):
        return to_date(value, source, text, date_formats)
    if isinstance(target, INSTANTS):
        return to_timestamp(value, source, text, timestamp_formats).cast(target)
    if isinstance(target, T.BooleanType):
        return to_boolean(value, source, text)
    if isinstance(target, WHOLE_NUMBERS):
        return to_long(value, source, text).try_cast(target)
    if isinstance(target, (T.FloatType, T.DoubleType)):
        return to_double(value, source, text).cast(target)
    if isinstance(target, T.DecimalType):
        return to_decimal(value, source, text, target)
    raise TypeError(f"no cast to {target.simpleString()}")


def to_date(value: Column, source: T.DataType, text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First format that fits; typed dates and instants are taken as they are."""
    if isinstance(source, (T.DateType, *INSTANTS)):
        return value.cast("date")
    return parse_first(single_blanks(strip(text)), formats, lambda s, p: F.try_to_timestamp(s, F.lit(p)).cast("date"))


def to_timestamp(
    value: Column, source: T.DataType, text: Column, formats: Sequence[str] = TIMESTAMP_FORMATS,
) -> Column:
    """Format list first, then epoch text: more than ten characters are milliseconds."""
    if isinstance(source, T.TimestampNTZType):
        return value
    if isinstance(source, (T.DateType, T.TimestampType)):
        return value.cast("timestamp_ntz")
    bare = F.regexp_replace(strip(text), "Z$", "")
    parsed = parse_first(
        single_blanks(bare), formats, lambda s, p: F.try_to_timestamp(s, F.lit(p)).cast("timestamp_ntz"))
    is_number, epoch = bare.rlike(WHOLE_SHAPE), from_epoch_text(bare)
    if any(compile_format(f).digits_only for f in formats):
        return F.coalesce(parsed, F.when(is_number, epoch))
    # No format fits a plain number, so numbers need not be held against the formats first.
    return F.when(is_number, epoch).otherwise(parsed)


def from_epoch_text(text: Column) -> Column:
    number = text.try_cast("bigint")
    millis = F.length(text) > EPOCH_SECONDS_MAX_LENGTH
    micros = (
        F.when(millis & number.between(FIRST_SECOND * 1000, LAST_SECOND * 1000 + 999), number * 1000)
        .when(~millis & number.between(FIRST_SECOND, LAST_SECOND), number * 1_000_000))
    # An interval on wall-clock time: the session's time zone has no part in it.
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.expr("INTERVAL '0.000001' SECOND") * micros


def to_boolean(value: Column, source: T.DataType, text: Column) -> Column:
    """Null and blank are null, a true word is true, any other text is false."""
    if isinstance(source, T.BooleanType):
        return value
    return F.when(text != "", F.lower(text).isin(*TRUE_WORDS))


def to_long(value: Column, source: T.DataType, text: Column) -> Column:
    """Text must be a whole number; numbers are truncated towards zero."""
    if isinstance(source, (*NUMBERS, *WHOLE_NUMBERS, T.BooleanType)):
        return value.try_cast("bigint")
    if isinstance(source, (T.DateType, *INSTANTS)):
        return F.lit(None).cast("bigint")
    if isinstance(source, T.VariantType):
        kind = variant_kind(value)
        text = F.try_variant_get(value, ROOT, "string")
        return (F.when(is_fractional(kind), text.try_cast("double").try_cast("bigint"))
                .when(kind == "BOOLEAN", (text == "true").cast("bigint"))
                .otherwise(_whole(text)))
    return _whole(text)


def _whole(text: Column) -> Column:
    # The shape first: a try_cast that fails throws and catches an exception.
    return F.when(text.rlike(PADDED_WHOLE_SHAPE), text.try_cast("bigint"))


def to_double(value: Column, source: T.DataType, text: Column) -> Column:
    """Text must be a number as a whole; infinities and NaN count as numbers."""
    if isinstance(source, (*NUMBERS, *WHOLE_NUMBERS, T.BooleanType)):
        return value.cast("double")
    if isinstance(source, (T.DateType, *INSTANTS)):
        return F.lit(None).cast("double")
    if isinstance(source, T.VariantType):
        text = F.try_variant_get(value, ROOT, "string")
        return (F.when(variant_kind(value) == "BOOLEAN", (text == "true").cast("double"))
                .otherwise(_fraction(text)))
    return _fraction(text)


def _fraction(text: Column) -> Column:
    return F.when(text.rlike(FLOAT_SHAPE), text.try_cast("double"))


def to_decimal(value: Column, source: T.DataType, text: Column, target: T.DecimalType) -> Column:
    if isinstance(source, (*NUMBERS, *WHOLE_NUMBERS)):
        return value.try_cast(target)
    if isinstance(source, (T.BooleanType, T.DateType, *INSTANTS)):
        return F.lit(None).cast(target)
    return F.when(text.rlike(FLOAT_SHAPE), text.try_cast(target))
