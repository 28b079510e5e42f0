"""The high-water mark of a table: the newest timestamp that was processed."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NO_MARK = "2020-01-01 00:00:00"  # fixed value: mark before the first run
EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def read_mark(spark: SparkSession, path: str, default: str = NO_MARK) -> DataFrame:
    """One row, ``mark``: the greatest value saved under ``path``, or the default.

    A frame and not a value: used as a scalar subquery the mark stays part of the plan.
    """
    fallback = F.lit(default).cast("timestamp_ntz")
    try:
        saved = spark.read.schema("mark timestamp_ntz").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        saved = spark.range(0).select(fallback.alias("mark"))
    return saved.agg(F.coalesce(F.max("mark"), fallback).alias("mark"))


def save_mark(df: DataFrame, ts: str, path: str) -> None:
    """Add the greatest ``ts`` of ``df``. Earlier marks stay, so a failed run loses none.

    A mark is wall-clock time, of instants that of UTC: it does not depend on the session's time zone.
    """
    greatest = df.agg(F.max(ts).alias("mark"))
    if isinstance(df.schema[ts].dataType, T.TimestampType):
        greatest = greatest.select(F.expr(f"{EPOCH} + INTERVAL '0.000001' SECOND * unix_micros(mark)").alias("mark"))
    greatest.select(F.col("mark").cast("timestamp_ntz").alias("mark")).filter("mark IS NOT NULL").write.mode("append").parquet(path)


def mark_for(df: DataFrame, ts: str, mark: DataFrame) -> Column:
    """The mark as a scalar of the type of ``ts``, to be compared with it as it is, so that readers can skip files by it."""
    if isinstance(df.schema[ts].dataType, T.TimestampType):
        mark = mark.select(F.timestamp_micros(F.expr(f"timestampdiff(MICROSECOND, {EPOCH}, mark)")).alias("mark"))
    return mark.scalar()


def newer_than_mark(df: DataFrame, ts: str, mark: DataFrame) -> DataFrame:
    """Rows past the mark."""
    return df.filter(F.col(ts) > mark_for(df, ts, mark))


def newest_value(df: DataFrame, ts: str) -> Column | None:
    """The greatest ``ts`` there is now, as a constant; None without one."""
    kind = df.schema[ts].dataType
    instant = isinstance(kind, T.TimestampType)
    value = df.agg(F.max(ts).alias("m")).select(F.unix_micros("m") if instant else F.col("m").cast("string")).head()[0]
    if value is None:
        return None
    return F.timestamp_micros(F.lit(value)) if instant else F.lit(value).cast(kind)
