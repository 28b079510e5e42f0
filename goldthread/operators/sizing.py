"""Size checks that stand before a broadcast or a driver-side read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bounds of a broadcast: rows, and bytes of them; a row has some bytes of its own.
BROADCAST_ROWS, BROADCAST_BYTES, ROW_BYTES = 500_000, 64 << 20, 16
METADATA_ROWS = 20_000


def fits(df: DataFrame, max_rows: int, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and about ``max_bytes`` bytes, by one distributed aggregate.

    A limit before the count would not be cheaper: every task would send up to that many rows to
    the one task that cuts them down. Long texts count by their bytes, nested values by those of their JSON text.
    """
    rows, size = df.agg(F.count(F.lit(1)), F.sum(_row_bytes(df))).head()
    return rows <= max_rows and (size or 0) <= max_bytes


def _row_bytes(df: DataFrame) -> Column:
    def of(field: T.StructField) -> Column:
        value = F.col(f"`{field.name.replace('`', '``')}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(value), F.lit(0))
        if isinstance(field.dataType, (T.StructType, T.MapType, T.ArrayType, T.VariantType)):
            return F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0))
        return F.lit(0)

    return sum((of(f) for f in df.schema.fields), F.lit(ROW_BYTES + 8 * len(df.columns)))


def metadata_rows(df: DataFrame, max_rows: int = METADATA_ROWS) -> list[Row]:
    """All rows of a metadata table on the driver; larger input is an error, never cut short."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"a metadata table may hold {max_rows} rows at the most")
    return rows


def semi_join(df: DataFrame, keys: DataFrame, on: str | Column, broadcast_rows: int | None = None) -> DataFrame:
    """Rows of ``df`` that have a match in ``keys``.

    With ``broadcast_rows`` the key set is counted first and broadcast when it is that small;
    otherwise, and beyond that size, the planner chooses the join.
    """
    if broadcast_rows is not None and fits(keys, broadcast_rows):
        keys = F.broadcast(keys)
    return df.join(keys, on, "left_semi")
