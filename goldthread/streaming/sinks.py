"""Stream sinks that can take the same batch twice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from goldthread.functions.calendar import PARTITIONS, WINDOW_MONTH, partition_columns, window_end
from goldthread.sources.sinks import write_parquet

BATCH = "batch_id"
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"


def write_batch(
    df: DataFrame,
    path: str,
    batch_id: int,
    partition_by: Sequence[str] = (),
    drop: Sequence[str] = (),
) -> None:
    """Append a micro-batch as the folder ``batch_id=N``, which a replay replaces as a whole.

    What the first try wrote and the second does not is thereby gone. Rows are rebalanced by folder: adaptive
    execution merges small folders into a task and splits a folder that holds much of the batch, by bytes.
    ``drop`` names columns not to write.
    """
    df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    (df.drop(*drop).write.mode("overwrite").option("compression", "snappy")
     .partitionBy(*partition_by).parquet(f"{path}/{BATCH}={batch_id}"))


def compact_batches(spark: SparkSession, path: str, target: str, partition_by: Sequence[str] = ()) -> None:
    """Write the rows of all micro-batch folders anew, in as few files as their size needs, without batch numbers.

    ``target`` is another folder; readers move to it, and the stream goes on below ``path``.
    """
    write_parquet(spark.read.parquet(path).drop(BATCH), target, partition_by=partition_by)


def with_window_partitions(df: DataFrame, ts: str, size: str = "5 minutes", month: str = WINDOW_MONTH) -> DataFrame:
    """Add the folder columns of the window that holds ``ts``."""
    framed = df.withColumn("_window_end", window_end(F.col(ts), size))
    return framed.withColumns(partition_columns(F.col("_window_end"), month)).drop("_window_end")


def start_window_files(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    ts: str = "publish_time",
    size: str = "5 minutes",
    month: str = WINDOW_MONTH,
    trigger: dict | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Write a stream as Parquet files in the folders of its windows.

    ``state_partitions`` sizes the state of a deduplicated stream. The first start fixes it for the
    life of the checkpoint, so it is given here and not taken from a setting made for batch jobs.

    Rows are brought together by folder before the write. The plain file sink would leave one file
    per task in every open folder, whatever the amount of rows.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(with_window_partitions(batch, ts, size, month), path, batch_id, PARTITIONS)

    writer = (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
              .trigger(**(trigger or {"availableNow": True})))
    if state_partitions is None:
        return writer.start()
    conf = stream.sparkSession.conf
    before = conf.get(SHUFFLE_PARTITIONS)
    conf.set(SHUFFLE_PARTITIONS, state_partitions)
    try:
        return writer.start()  # a stream keeps the settings of its start
    finally:
        conf.set(SHUFFLE_PARTITIONS, before)
