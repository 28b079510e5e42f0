"""Run and window folders in a named time zone."""

from __future__ import annotations

from datetime import datetime, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ZONE = "Asia/Bangkok"  # UTC+7, no daylight saving
PARTITIONS = ("par_month", "par_day", "par_hour", "run_dt")
BATCH_MONTH, WINDOW_MONTH = "yyyyMM", "MM"


def partition_columns(instant: Column, month: str = BATCH_MONTH, zone: str = ZONE) -> dict[str, Column]:
    """Folder values of an instant, in wall-clock time of ``zone`` and whatever the session's zone is."""
    text = local_time(instant, zone).cast("string")  # yyyy-MM-dd HH:mm:ss
    year, month_, day, hour = (F.substring(text, at, n) for at, n in ((1, 4), (6, 2), (9, 2), (12, 2)))
    values = ({BATCH_MONTH: F.concat(year, month_), WINDOW_MONTH: month_}[month], day, hour,
              F.concat(year, month_, day, hour))
    return dict(zip(PARTITIONS, values))


def local_time(instant: Column, zone: str = ZONE) -> Column:
    """The wall-clock time of an instant in ``zone``, without zone. The session's zone plays no part."""
    seconds = F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")
    utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def with_run_partitions(df: DataFrame, run_time: datetime, month: str = BATCH_MONTH, zone: str = ZONE) -> DataFrame:
    """Add the run's folder values as constants. A naive ``run_time`` is UTC."""
    if run_time.tzinfo is None:
        run_time = run_time.replace(tzinfo=timezone.utc)
    local = run_time.astimezone(ZoneInfo(zone))
    python_formats = {BATCH_MONTH: "%Y%m", WINDOW_MONTH: "%m"}
    values = (local.strftime(f) for f in (python_formats[month], "%d", "%H", "%Y%m%d%H"))
    return df.withColumns({name: F.lit(v) for name, v in zip(PARTITIONS, values)})


def with_run_partitions_from_text(df: DataFrame, run_dt: str, month: str = BATCH_MONTH) -> DataFrame:
    """As ``with_run_partitions`` for a given ``yyyyMMddHH`` text in local time."""
    local = datetime.strptime(run_dt, "%Y%m%d%H").replace(tzinfo=ZoneInfo(ZONE))
    return with_run_partitions(df, local, month)


def window_end(ts: Column, size: str = "5 minutes") -> Column:
    """End of the tumbling window that holds ``ts``."""
    return F.window(ts, size).getField("end")


def with_window_path(
    df: DataFrame, ts: str, size: str = "5 minutes", month: str = WINDOW_MONTH, zone: str = ZONE,
) -> DataFrame:
    """Add the folder text and the local end of each row's window."""
    framed = df.withColumn("_window_end", window_end(F.col(ts), size))
    parts = partition_columns(F.col("_window_end"), month, zone)
    path = F.concat_ws("/", *[F.concat(F.lit(f"{name}="), value) for name, value in parts.items()])
    return (framed.withColumn("_window_path", path)
            .withColumn("_window_timestamp", local_time(F.col("_window_end"), zone))
            .drop("_window_end"))


def drop_window_columns(df: DataFrame) -> DataFrame:
    return df.drop("_window_path", "_window_timestamp")
