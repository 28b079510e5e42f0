"""Wide-column rows kept as a table of versioned cells.

A cell table has the columns ``row_key, family, qualifier, ts, value`` with ``value`` BINARY.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldthread.functions.extract import whole_json
from goldthread.functions.text import utf8_or_hex, utf8_text
from goldthread.operators.sizing import semi_join

CELL = ("row_key", "family", "qualifier")
WHOLE_ROW = "value"  # fixed value: qualifier of a family that is one document
SPREAD, COPIES = "__spread", "__copies"
BUCKET = "key_bucket"  # partition column of a bucketed cell table


def cells_by_keys(cells: DataFrame, keys: Sequence[str] | DataFrame, broadcast_rows: int | None = None) -> DataFrame:
    """Cells of the given row keys: a list, or a DataFrame with a ``row_key`` column."""
    if not isinstance(keys, DataFrame):
        keys = cells.sparkSession.createDataFrame([(k,) for k in keys], "row_key string")
    return semi_join(cells_of_buckets(cells, keys), keys.select("row_key"), "row_key", broadcast_rows)


def key_bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_cells(cells: DataFrame, path: str, buckets: int, mode: str = "append") -> None:
    """Cells as Parquet in folders by the hash of their row key, sorted by it within a file.

    A read of some keys then opens their folders only, and skips row groups by the key's statistics.
    The number of buckets is kept in the folder name, so readers need not be told.
    """
    framed = cells.withColumn(BUCKET, F.concat(F.lit(f"{buckets}-"), key_bucket(F.col("row_key"), buckets)))
    (framed.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, "row_key").write.mode(mode).partitionBy(BUCKET).parquet(path))


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """A cell table of ``write_cells``, with its bucket as a column."""
    schema = "row_key string, family string, qualifier string, ts timestamp, value binary"
    return spark.read.schema(f"{schema}, {BUCKET} string").parquet(path)


def cells_of_buckets(cells: DataFrame, keys: DataFrame) -> DataFrame:
    """Of a bucketed table the folders that hold the ``row_key`` values of ``keys``; other tables as they are.

    The folder names in use are read by the driver: at most as many as the table has buckets.
    """
    if BUCKET not in cells.columns:
        return cells
    sizes = {int(r[0].split("-")[0]) for r in cells.select(BUCKET).distinct().collect()}
    wanted = [f"{n}-{r[0]}" for n in sizes for r in keys.select(key_bucket(F.col("row_key"), n)).distinct().collect()]
    return cells.filter(F.col(BUCKET).isin(wanted)).drop(BUCKET)


def cells_by_ranges(cells: DataFrame, ranges: Sequence[tuple[str | None, str | None]]) -> DataFrame:
    """Cells whose key lies in one of the half-open ranges; None leaves an end open.

    Overlapping ranges are merged first, so the filter stays short.
    """
    merged: list[tuple[str, str | None]] = []
    for low, high in sorted(((lo or "", hi) for lo, hi in ranges), key=lambda r: r[0]):
        if merged and (merged[-1][1] is None or low <= merged[-1][1]):
            last_low, last_high = merged[-1]
            reach = None if last_high is None or high is None else max(last_high, high)
            merged[-1] = (last_low, reach)
        else:
            merged.append((low, high))
    wanted = F.lit(False)
    for low, high in merged:
        inside = F.col("row_key") >= low
        wanted = wanted | (inside if high is None else inside & (F.col("row_key") < high))
    return cells.filter(wanted)


def of_families(cells: DataFrame, families: Sequence[str] | None) -> DataFrame:
    return cells if families is None else cells.filter(F.col("family").isin(list(families)))


def latest_cells(cells: DataFrame) -> DataFrame:
    """Newest version of every cell; among equal times the greatest value.

    An aggregate with a map-side part: a row with many versions shrinks before the shuffle.
    """
    newest = cells.groupBy(*CELL).agg(F.max(F.struct("ts", "value")).alias("newest"))
    return newest.select(*CELL, "newest.value", "newest.ts")


def row_maps(cells: DataFrame, families: Sequence[str] | None = None) -> DataFrame:
    """One row per key with every qualifier found: a map from ``family:qualifier`` to the newest value as text.

    A row's map is gathered in one task; it is as large as the row, whatever the number of rows.
    """
    newest = latest_cells(of_families(cells, families)).select(
        "row_key", F.struct(F.concat_ws(":", "family", "qualifier").alias("key"), utf8_or_hex(F.col("value")).alias("value")).alias("cell"))
    return newest.groupBy("row_key").agg(F.map_from_entries(F.sort_array(F.collect_list("cell"))).alias("cells"))


def flatten_cells(cells: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """One row per key with a text column ``family:qualifier`` for each of ``columns``."""
    wanted = F.struct("family", "qualifier").isin(
        *[F.struct(F.lit(f).alias("family"), F.lit(q).alias("qualifier")) for f, q in columns])
    version = F.struct("ts", "value")
    newest = [
        utf8_or_hex(F.max(F.when((F.col("family") == f) & (F.col("qualifier") == q), version))["value"])
        .alias(f"{f}:{q}") for f, q in columns]
    return cells.filter(wanted).groupBy("row_key").agg(*newest)


def cell_json(value: Column) -> Column:
    """A cell as JSON: objects and arrays as they are, other text quoted, bad UTF-8 as quoted hex."""
    text = utf8_text(value)
    is_json = text.rlike(r"^[\[{]") & whole_json(text).isNotNull()
    return F.when(is_json, text).otherwise(quoted_json(utf8_or_hex(value)))


def quoted_json(text: Column) -> Column:
    return F.to_json(text.cast("variant"))


def family_document(cells: Column) -> Column:
    """JSON object of a family from an array of ``struct<qualifier, json>``.

    A family with the single qualifier ``value`` is that document itself; an array is put under
    ``data`` and other text under ``value``. Otherwise every qualifier is a key.
    """
    members = F.array_join(
        F.transform(cells, lambda c: F.concat(quoted_json(c["qualifier"]), F.lit(":"), c["json"])), ",")
    only = F.get(cells, F.lit(0))
    single = (F.size(cells) == 1) & (only["qualifier"] == WHOLE_ROW)
    return (
        F.when(single & only["json"].startswith("{"), only["json"])
        .when(single & only["json"].startswith("["), F.concat(F.lit('{"data":'), only["json"], F.lit("}")))
        .otherwise(F.concat(F.lit("{"), members, F.lit("}"))))


def row_documents(cells: DataFrame, families: Sequence[str] = ("profiles",)) -> DataFrame:
    """One row per key with a JSON text column per family; a family the row lacks is ``{}``.

    Values of other families are dropped before the shuffle; they only show that the row exists. A
    row's document is put together in one task; it is as large as the row, whatever the number of rows.
    """
    asked = F.col("family").isin(list(families))
    slim = cells.select(
        "row_key", *[F.when(asked, F.col(c)).alias(c) for c in ("family", "qualifier", "ts", "value")])
    newest = latest_cells(slim).select("row_key", "family", "qualifier", cell_json(F.col("value")).alias("json"))
    by_family = newest.groupBy("row_key").agg(*[
        F.sort_array(F.collect_list(F.when(F.col("family") == f, F.struct("qualifier", "json")))).alias(f)
        for f in families])
    return by_family.select("row_key", *[family_document(F.col(f)).alias(f) for f in families])


def enrich_by_key(
    events: DataFrame,
    cells: DataFrame,
    key: str,
    families: Sequence[str] = ("profiles",),
    broadcast_rows: int | None = None,
    spread: int = 200,
) -> DataFrame:
    """Events with the documents of their row; an event without a row is dropped.

    Keys are looked up once, however many events have them; see ``documents_of_keys`` and ``join_by_key``.
    """
    counts = key_counts(events, key)
    documents = documents_of_keys(cells, counts, key, families, broadcast_rows)
    return join_by_key(events, documents, counts, key, spread)


def key_counts(events: DataFrame, key: str) -> DataFrame:
    """One row ``row_key, n`` per key of the events. It is read several times: keep it where counting is dear."""
    return events.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("row_key")).agg(F.count(F.lit(1)).alias("n"))


def documents_of_keys(
    cells: DataFrame,
    counts: DataFrame,
    key: str,
    families: Sequence[str] = ("profiles",),
    broadcast_rows: int | None = None,
) -> DataFrame:
    """The documents of the counted keys, one row per key that has cells.

    Of a bucketed cell table only the folders of the keys are opened, the cells are cut down to the keys (broadcast with
    ``broadcast_rows`` if they are counted to be that few), and every row is reduced to its newest cells.
    """
    wanted = cells_by_keys(cells, counts.select("row_key"), broadcast_rows)
    return row_documents(wanted, families).withColumnRenamed("row_key", key)


def join_by_key(events: DataFrame, documents: DataFrame, counts: DataFrame, key: str, spread: int = 200) -> DataFrame:
    """Events with the one row that ``documents`` has of their key; an event without one is dropped.

    A key with more than one part in ``spread`` of the events gets a copy of its documents for each such part, over which its
    events are dealt: a key with a third of the events is joined in ``spread / 3`` tasks, and the documents of all other keys
    are laid out once. There are fewer than ``spread`` such keys.
    """
    total = counts.agg(F.sum("n").alias("n")).scalar()
    hot = F.broadcast(counts.select(F.col("row_key").alias(key), F.ceil(F.col("n") * spread / total).cast("int").alias(COPIES))
                      .filter(F.col(COPIES) > 1))
    copies = F.coalesce(F.col(COPIES), F.lit(1))
    dealt = events.join(hot, key, "left").withColumn(SPREAD, F.pmod(F.xxhash64(*_hashable(events)), copies).cast("int")).drop(COPIES)
    laid = documents.join(hot, key, "left").withColumn(SPREAD, F.explode(F.sequence(F.lit(0), copies - 1))).drop(COPIES)
    return dealt.join(laid, [key, SPREAD]).drop(SPREAD)


def _hashable(df: DataFrame) -> list[Column]:
    return [F.col(f.name) for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]


def has_text(df: DataFrame, value: Column) -> DataFrame:
    """Rows whose value is not null and not blank."""
    return df.filter(value.rlike(r"\S"))
