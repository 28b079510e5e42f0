"""Writing tables, Parquet folders and line files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldthread.functions.text import utf8_text
from goldthread.operators.changes import (
    CHANGE_TYPE, apply_latest, latest_changes)
from goldthread.operators.normalize import serialize_nested
from goldthread.operators.sizing import BROADCAST_ROWS, metadata_rows

BUCKET, GONE = "__bucket", "__gone"
NEXT, PREVIOUS = "__next", "__previous"


def write_table(
    df: DataFrame, table: str, write: str = "append", create: bool = True, ignore_unknown: bool = False,
) -> None:
    """Write to a catalog table.

    ``write`` is ``append``, ``truncate`` (replace the rows) or ``empty`` (an error if there are
    rows). Without ``create`` the table must exist. Columns that the table lacks are an error, or
    left out with ``ignore_unknown``; columns that ``df`` lacks are null. Names are compared as the
    session compares them, so without case unless it is case sensitive.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(table)
    if write not in ("append", "truncate", "empty"):
        raise ValueError(f"unknown write mode {write}")
    if not exists:
        if not create:
            raise ValueError(f"table {table} does not exist")
        df.write.saveAsTable(table, format="parquet", mode="errorifexists")
        return
    if write == "empty" and not spark.table(table).isEmpty():
        raise ValueError(f"table {table} has rows")
    _aligned(df, spark.table(table).schema, ignore_unknown).write.insertInto(table, overwrite=write == "truncate")


def _aligned(df: DataFrame, target: T.StructType, ignore_unknown: bool) -> DataFrame:
    """``df`` with the columns of ``target`` in its order and types."""
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    own: dict[str, str] = {}
    for name in df.columns:
        key = name if exact else name.lower()
        if key in own:
            raise ValueError(f"columns {own[key]} and {name} have one name")
        own[key] = name
    known = {f.name if exact else f.name.lower(): f for f in target.fields}
    unknown = [name for key, name in own.items() if key not in known]
    if unknown and not ignore_unknown:
        raise ValueError(f"the table has no columns {', '.join(unknown)}")
    return df.select(*[
        (F.col(f"`{own[key].replace('`', '``')}`") if key in own else F.lit(None)).cast(f.dataType).alias(f.name)
        for key, f in known.items()])


def swap_table(df: DataFrame, table: str) -> None:
    """Replace a table whose rows ``df`` may itself read.

    The rows go to a table of their own first, one of the same definition where there is one, so that
    partition columns and comments stay. Then the names are exchanged. A run that dies
    between two renames is finished by the next call, so no state is lost.
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table + NEXT}")
    exists = spark.catalog.tableExists(table)
    if exists and set(spark.table(table).columns) == set(df.columns):
        spark.sql(f"CREATE TABLE {table + NEXT} LIKE {table}")
        _aligned(df, spark.table(table).schema, False).write.insertInto(table + NEXT)
    else:
        df.write.saveAsTable(table + NEXT, format="parquet", mode="overwrite")
    if exists:
        spark.sql(f"DROP TABLE IF EXISTS {table + PREVIOUS}")
        spark.sql(f"ALTER TABLE {table} RENAME TO {table + PREVIOUS}")
    spark.sql(f"ALTER TABLE {table + NEXT} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {table + PREVIOUS}")


def recover_table(spark: SparkSession, table: str) -> None:
    """Undo an exchange of names that stopped half way."""
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(table + PREVIOUS):
        spark.sql(f"ALTER TABLE {table + PREVIOUS} RENAME TO {table}")


def upsert_table(changes: DataFrame, table: str, pk: Sequence[str], order: Sequence[str]) -> None:
    """Apply change rows to a plain Parquet table, which is rewritten; see ``upsert_buckets`` for large ones."""
    spark = changes.sparkSession
    recover_table(spark, table)
    latest = latest_changes(changes, pk, order).persist()  # counted, joined and written
    try:
        swap_table(apply_latest(spark.table(table), latest, pk, BROADCAST_ROWS), table)
    finally:
        latest.unpersist()


def write_buckets(df: DataFrame, path: str, pk: Sequence[str], buckets: int) -> None:
    """Rows as Parquet in ``buckets`` folders by the hash of their key, for ``upsert_buckets``."""
    write_parquet(df.withColumns({GONE: F.lit(False), BUCKET: key_bucket(pk, buckets)}), path, partition_by=[BUCKET])


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).filter(~F.col(GONE)).drop(GONE, BUCKET)


def key_bucket(pk: Sequence[str], buckets: int):
    return F.pmod(F.xxhash64(*[F.col(c) for c in pk]), F.lit(buckets)).cast("int")


def upsert_buckets(changes: DataFrame, path: str, pk: Sequence[str], order: Sequence[str], buckets: int) -> None:
    """Apply change rows to a table of ``write_buckets``; only the folders of changed keys are read and rewritten.

    A deleted row stays as a mark until its folder is written again, so a folder that lost all its rows is
    replaced as well. The numbers of the changed folders, at most ``buckets``, are read by the driver.
    """
    spark = changes.sparkSession
    latest = latest_changes(changes, pk, order).withColumn(BUCKET, key_bucket(pk, buckets)).persist()
    try:
        touched = [r[0] for r in latest.select(BUCKET).distinct().collect()]
        current = spark.read.parquet(path)
        columns = [c for c in current.columns if c not in (GONE, BUCKET)]
        kept = current.filter(F.col(BUCKET).isin(touched) & ~F.col(GONE)).join(
            latest.select(*pk), list(pk), "left_anti").select(*columns, GONE, BUCKET)
        changed = latest.select(*columns, (F.col(CHANGE_TYPE) == "DELETE").alias(GONE), BUCKET)
        write_parquet(kept.unionByName(changed), path, partition_by=[BUCKET])
    finally:
        latest.unpersist()


def load_snapshot(spark: SparkSession, source: str, table: str) -> None:
    """Replace a table by the Parquet files of a folder."""
    recover_table(spark, table)
    swap_table(spark.read.parquet(source), table)


def write_parquet(
    df: DataFrame,
    path: str,
    *,
    shards: int | None = None,
    partition_by: Sequence[str] = (),
    gather: Sequence[str] | None = None,
    mode: str = "overwrite",
) -> None:
    """Snappy Parquet files, ``shards`` of them or as many as the data needs.

    Without a count Spark rebalances the rows before the write: small partitions are merged, and a
    folder that holds much of the data is split over several tasks. Rows with equal ``gather``
    columns are brought together for that, by default those of one folder. With ``partition_by``
    only the folders that get rows are replaced.
    """
    if shards is not None:
        df = df.repartition(shards)
    else:
        df = df.hint("rebalance", *[F.col(c) for c in (partition_by if gather is None else gather)])
    writer = df.write.mode(mode).option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_state(df: DataFrame, path: str, fmt: str = "json") -> None:
    """One row of run state as one file; more rows are an error."""
    rows = metadata_rows(df, 1)
    write_lines(df.sparkSession.createDataFrame(rows, df.schema).coalesce(1), path, fmt)


def write_lines(df: DataFrame, path: str, fmt: str = "text") -> None:
    """Text or JSON lines, replacing what is there; every task writes a part file of the folder."""
    if fmt not in ("text", "json"):
        raise ValueError(f"unsupported format {fmt}")
    if fmt == "json":
        # Null members are kept: an absent key and a null are not the same.
        df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    else:
        df.select(_as_line(df)).write.mode("overwrite").text(path)


def _as_line(df: DataFrame):
    if len(df.columns) == 1 and isinstance(df.schema[0].dataType, T.StringType):
        return F.col(f"`{df.columns[0]}`").alias("value")
    return F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")


def dead_letter_lines(dead: DataFrame) -> DataFrame:
    """Failed messages as one JSON text each, for a text or message-queue sink.

    The payload ``data`` is text where it is UTF-8; other bytes are base64, and ``data_encoding`` says which.
    """
    if "data" in dead.columns and isinstance(dead.schema["data"].dataType, T.BinaryType):
        text = utf8_text(F.col("data"))
        dead = dead.withColumns({
            "data": F.coalesce(text, F.base64("data")),
            "data_encoding": F.when(F.col("data").isNotNull(), F.when(text.isNull(), "base64").otherwise("utf-8"))})
    return serialize_nested(dead.select(F.struct("*").alias("value")))


def rows_written(df: DataFrame, group: str) -> DataFrame:
    """Audit rows: how many records each output group holds."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n_rows"))


def record_exists(df: DataFrame, column: str, value: object) -> bool:
    return not df.filter(F.col(column) == F.lit(value)).limit(1).isEmpty()
