from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldthread.functions.formats import compile_format
from goldthread.functions.text import float_text
from goldthread.operators.normalize import Formats, fill_columns, ignore_unknown, normalize_to_schema, serialize_nested
from goldthread.sources.readers import schema_from_list


def cast(spark, values, source, target, formats=Formats()):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {source}")
    schema = T.StructType([T.StructField("i", T.LongType()), T.StructField("v", target)])
    return [r.v for r in normalize_to_schema(df, schema, formats).orderBy("i").collect()]


def cast_json(spark, values, target):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, j string")
    df = df.select("i", F.from_json("j", "v variant").getField("v").alias("v"))
    schema = T.StructType([T.StructField("i", T.LongType()), T.StructField("v", target)])
    return [r.v for r in normalize_to_schema(df, schema).orderBy("i").collect()]


def test_strings(spark):
    assert cast(spark, [None, "", " x "], "string", T.StringType()) == ["", "", " x "]
    assert cast(spark, [True, None], "boolean", T.StringType()) == ["true", ""]
    assert cast(spark, [5, None], "bigint", T.StringType()) == ["5", ""]
    assert cast(spark, [1e7, 0.5, 1e16, 1e-5, float("inf")], "double", T.StringType()) == [
        "10000000.0", "0.5", "1e+16", "1e-05", "inf"]


@pytest.mark.parametrize("value", [
    0.0, -0.0, 1.0, 1e7, 12345678.9, 9999999999999998.0, 1e16, 1.5e300, 1e-3, 1.23e-4, 9.9e-5, -7.25, 1e22,
    123456.789e3, 1e100, -2.5e-101, float("nan"), float("inf"), float("-inf")])
def test_float_text(spark, value):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(float_text(F.col("v")).alias("t")).first().t == repr(value)


def test_dates(spark):
    texts = ["2024-01-02", "2/1/2024", "2024/1/2", " 2024-1-2\t", "2024-02-30", "2024-01-02 10:00:00", "24-01-02",
             "", None, "x", "02024-01-02", "2024-01-02x"]
    d = date(2024, 1, 2)
    assert cast(spark, texts, "string", T.DateType()) == [d, d, d, d, None, None, None, None, None, None, None, None]
    assert cast(spark, [datetime(2024, 1, 2, 23, 59)], "timestamp_ntz", T.DateType()) == [d]
    assert cast(spark, ["02.01.2024", "2024-01-02"], "string", T.DateType(), Formats(date=["%d.%m.%Y"])) == [d, None]


def test_timestamps(spark):
    t, tf = datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4, 5, 120000)
    texts = ["2024-01-02 03:04:05.12", "2024-1-2 3:4:5", "2024-01-02T03:04:05.120000Z", "2024-01-02T03:04:05",
             "2024-01-02 \t03:04:05", "2024-01-02", "2024-01-02T03:04:05ZZ", "2024-01-02 03:04:60", "", None]
    assert cast(spark, texts, "string", T.TimestampNTZType()) == [tf, t, tf, t, t, None, None, None, None, None]


def test_epochs(spark):
    texts = ["1700000000", "1700000000123", "-1", "0", "1700000000Z", "17e8", "1700000000.5", "99999999999999999999",
             " 1700000000 ", "253402300799000", "253402300800000"]
    t = datetime(2023, 11, 14, 22, 13, 20)
    assert cast(spark, texts, "string", T.TimestampNTZType()) == [
        t, t.replace(microsecond=123000), datetime(1969, 12, 31, 23, 59, 59), datetime(1970, 1, 1), t, None, None, None,
        t, datetime(9999, 12, 31, 23, 59, 59), None]
    assert cast(spark, [1700000000], "bigint", T.TimestampNTZType()) == [t]
    assert cast_json(spark, ['{"v":1700000000123}'], T.TimestampNTZType()) == [t.replace(microsecond=123000)]


def test_formats_of_digits_come_before_epochs(spark):
    formats = Formats(timestamp=["%Y%m%d%H", "%d %b %Y"])
    assert cast(spark, ["2024010203", "1700000000", "02  Jan\t2024"], "string", T.TimestampNTZType(), formats) == [
        datetime(2024, 1, 2, 3), datetime(2023, 11, 14, 22, 13, 20), datetime(2024, 1, 2)]


def test_booleans(spark):
    texts = ["true", "TRUE", "1", "yes", "no", "false", "0", " true", "x", "", None]
    assert cast(spark, texts, "string", T.BooleanType()) == [True] * 4 + [False] * 5 + [None, None]
    assert cast(spark, [1, 0, 2], "bigint", T.BooleanType()) == [True, False, False]
    assert cast(spark, [1.0], "double", T.BooleanType()) == [False]
    assert cast_json(spark, ['{"v":true}', '{"v":1}', '{"v":"Yes"}', '{"v":null}'], T.BooleanType()) == [
        True, True, True, None]


def test_whole_numbers(spark):
    texts = ["12", " +12 ", "-7", "12.5", "1e3", "", "x", None, "9223372036854775808", "12.", "1d"]
    assert cast(spark, texts, "string", T.LongType()) == [12, 12, -7] + [None] * 8
    assert cast(spark, [12.9, -12.9, float("nan"), 1e30, None], "double", T.LongType()) == [12, -12, None, None, None]
    assert cast(spark, [True], "boolean", T.LongType()) == [1]
    assert cast_json(spark, ['{"v":12.9}', '{"v":"12.9"}', '{"v":true}', '{"v":"7"}', '{"v":{"a":1}}'],
                     T.LongType()) == [12, None, 1, 7, None]


def test_doubles(spark):
    texts = ["1.5", ".5", "5.", " 1e3 ", "+2", "1d", "2f", "0x1p3", "1_0", "", "x", None]
    assert cast(spark, texts, "string", T.DoubleType()) == [1.5, 0.5, 5.0, 1000.0, 2.0] + [None] * 7
    assert cast(spark, ["inf", "-Infinity"], "string", T.DoubleType()) == [float("inf"), float("-inf")]
    assert cast_json(spark, ['{"v":true}', '{"v":2}', '{"v":"2.5"}'], T.DoubleType()) == [1.0, 2.0, 2.5]


def test_decimals(spark):
    texts = ["1.123456789", "12345678901234567890123456789.5", "x", "", None, "1" * 31]
    assert cast(spark, texts, "string", T.DecimalType(38, 9)) == [
        Decimal("1.123456789"), Decimal("12345678901234567890123456789.500000000"), None, None, None, None]


def test_missing_and_extra_columns(spark):
    df = spark.createDataFrame([("a", 1)], "s string, extra int")
    schema = schema_from_list([
        {"name": "s", "type": "STRING"}, {"name": "t"}, {"name": "n", "type": "INT64"}, {"type": "DATE"},
        {"name": "d", "type": "date"}, {"name": "o", "type": "GEOGRAPHY"}])
    assert schema.simpleString() == "struct<s:string,t:string,n:bigint,d:date,o:string>"
    assert normalize_to_schema(df, schema).first().asDict() == {"s": "a", "t": "", "n": None, "d": None, "o": ""}
    assert normalize_to_schema(df, schema, null_text=None).first().asDict()["t"] is None


def test_nested_values_in_text_columns(spark):
    df = spark.sql("SELECT named_struct('a', 1) AS s, map('k', 2) AS m, parse_json('{\"b\":[1]}') AS v, array(1) AS l")
    assert serialize_nested(df).first().asDict() == {"s": '{"a":1}', "m": '{"k":2}', "v": '{"b":[1]}', "l": [1]}
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("s", "m", "v", "l")])
    assert normalize_to_schema(df, schema).first().l == "[1]"


def test_fill_and_ignore(spark):
    df = spark.createDataFrame([("1", "2")], "b string, a string")
    assert fill_columns(df, ["a", "c", "b"]).columns == ["a", "c", "b"]
    assert ignore_unknown(df, ["a", "z", "b"]).columns == ["a", "b"]
    assert ignore_unknown(df, ["A"]).columns == []


def test_formats():
    assert compile_format("%Y-%m-%dT%H:%M:%S.%f").pattern == "yyyy-M-d'T'H:m:s.SSSSSS"
    assert compile_format("%d %b  %Y").pattern == "d' 'MMM' 'yyyy".replace("' '", " ")
    assert [compile_format(f).digits_only for f in ("%Y%m%d", "%Y-%m-%d", "%H%M %p", "%Y.%m")] == [
        True, False, False, False]
    with pytest.raises(ValueError):
        compile_format("%Y-%q")
