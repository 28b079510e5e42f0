"""What the operators of this package share: frames of texts, written tables, slices of bounded size."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS = 1000
SLICE_BYTES = 1 << 20
ROW = "__row"


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, or below the warehouse where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_ROWS`` rows, so that a batch of long texts fits in a worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage, and lost executors lose nothing."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one where ``df`` has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_rows(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns and a number for each row.

    The number is the row's place in its input split, the same in every scan of the same files, so
    ``docs`` has to be files or a written table. It tells repeated rows apart.
    """
    return docs.select(*columns, F.monotonically_increasing_id().alias(ROW))


def stretches(data: bytes, stop: re.Pattern, most: int) -> Iterator[bytes]:
    """A long text cut before the first ``stop`` behind every ``most`` bytes, so that what is made of it at a time stays small."""
    at = 0
    while at < len(data) or at == 0:
        found = stop.search(data, at + most)
        end = found.start() if found else len(data)
        yield data[at:end]
        if end == len(data):
            return
        at = end


def text_of(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """A text column with null as the empty text."""
    return pc.fill_null(batch.column(column).cast(pa.large_string()), "")


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch of about ``most`` bytes of text; a longer text is a piece of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)
