"""Reading queries, text, JSON lines and schemas."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldthread.functions.extract import CLOSE, OPEN, whole_json

# Target type names; every other name is a string column.
TYPE_NAMES: dict[str, T.DataType] = {
    "INT64": T.LongType(),
    "INTEGER": T.LongType(),
    "INT32": T.LongType(),
    "FLOAT64": T.DoubleType(),
    "FLOAT": T.DoubleType(),
    "DOUBLE": T.DoubleType(),
    "NUMERIC": T.DecimalType(38, 9),
    "BOOLEAN": T.BooleanType(),
    "BOOL": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampNTZType(),
}


def read_query(
    spark: SparkSession,
    query: str,
    args: Mapping[str, Any] | None = None,
    views: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Rows of a SQL query.

    Values come in as named arguments (``:name``), table names as ``IDENTIFIER(:name)``, and
    DataFrames as temporary views. A query that is blank or still holds ``{`` is an error.
    """
    if not query or not query.strip():
        raise ValueError("the query is empty")
    if "{" in query:
        raise ValueError(f"unresolved template in query: {query}")
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(query, args=dict(args or {}))


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines with a known schema, or one VARIANT column ``value`` when the shape is open.

    A line that is not exactly one JSON value is an error: what follows a first value is not overlooked. Blank lines are left out.
    """
    lines = spark.read.text(path).filter(F.trim("value") != "")
    others = [c for c in lines.columns if c != "value"]
    if schema is not None:
        inside = T.ArrayType(T.StructType([T.StructField("v", T.StructType.fromDDL(schema) if isinstance(schema, str) else schema)]))
        row = F.from_json(F.concat(F.lit(OPEN), F.col("value"), F.lit(CLOSE)), inside, {"mode": "FAILFAST"})
        return lines.select(F.get(row, F.lit(0)).alias("row"), *others).select("row.v.*", *others)
    wrong = F.raise_error(F.concat(F.lit("not one JSON value: "), F.substring("value", 1, 200)))
    return lines.select(F.coalesce(whole_json(F.col("value")), wrong.cast("string").cast("variant")).alias("value"), *others)


def schema_from_list(fields: Iterable[Mapping[str, Any]]) -> T.StructType:
    """Schema of a ``[{name, type}]`` list; unnamed entries are skipped."""
    return T.StructType([
        T.StructField(f["name"], TYPE_NAMES.get((f.get("type") or "STRING").upper(), T.StringType()))
        for f in fields if f.get("name")])


def schema_from_json_file(spark: SparkSession, path: str) -> T.StructType:
    """Schema of a JSON file that holds a ``[{name, type}]`` list."""
    return schema_from_list(json.loads(spark.read.text(path, wholetext=True).head()["value"]))


def schema_of_source(
    spark: SparkSession,
    *,
    json_file: str | None = None,
    query: str | None = None,
    table: str | None = None,
) -> T.StructType:
    """Target schema: a JSON file first, else a query, else a table. Nothing of them is an error.

    A query is analysed and not run.
    """
    if json_file:
        return schema_from_json_file(spark, json_file)
    if query:
        return _as_targets(spark.sql(query).schema)
    if table:
        return _as_targets(spark.table(table).schema)
    raise ValueError("a target schema needs a JSON file, a query or a table")


def _as_targets(schema: T.StructType) -> T.StructType:
    """Column types as target types: whole numbers are LONG, instants wall-clock time, others text."""
    def target(dtype: T.DataType) -> T.DataType:
        if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            return T.LongType()
        if isinstance(dtype, (T.FloatType, T.DoubleType)):
            return T.DoubleType()
        if isinstance(dtype, T.DecimalType):
            return T.DecimalType(38, 9)
        if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            return T.TimestampNTZType()
        return dtype if isinstance(dtype, (T.BooleanType, T.DateType)) else T.StringType()

    return T.StructType([T.StructField(f.name, target(f.dataType)) for f in schema.fields])
