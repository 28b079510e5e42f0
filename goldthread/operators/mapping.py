"""The mapping table: which source path fills a destination column, and which side wins.

The table is metadata. It is read on the driver and compiled into one projection, so the rows of
the data never meet it at run time.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldthread.functions.extract import extract_paths
from goldthread.functions.paths import split_path, strict_path
from goldthread.operators.latest import latest_per_key, newest
from goldthread.operators.sizing import METADATA_ROWS, metadata_rows

UNDATED = "1999-12-31"  # fixed value: snapshot date of rows without one


@dataclass(frozen=True)
class MappingColumns:
    """Column names of a mapping table."""

    dest: str = "dest"
    path: str = "path"
    retrieved: str = "retrieved"
    confirmed: str = "confirmed"
    updated: str = "updated_date"
    table: str = "table_name"


@dataclass(frozen=True)
class MappingRow:
    dest: str
    path: str | None
    retrieved: bool
    confirmed: bool
    table: str | None = None

    def applies(self, mode: str) -> bool:
        """``reconcile`` follows the retrieved flag, ``original`` the confirmed flag."""
        return {"reconcile": self.retrieved, "original": self.confirmed}[mode]


def latest_snapshot(mapping: DataFrame, columns: MappingColumns = MappingColumns()) -> DataFrame:
    """All rows of the newest snapshot date; undated rows count as 1999-12-31."""
    newest_date = mapping.agg(F.coalesce(F.max(columns.updated), F.lit(UNDATED))).scalar()
    return mapping.filter(F.coalesce(F.col(columns.updated), F.lit(UNDATED)) == newest_date)


def latest_per_column(mapping: DataFrame, columns: MappingColumns = MappingColumns()) -> DataFrame:
    """The newest row of every destination column; among equal dates the greatest path."""
    return latest_per_key(mapping, [columns.dest], newest(columns.updated, columns.path))


def compile_mapping(
    mapping: DataFrame, columns: MappingColumns = MappingColumns(), max_columns: int = METADATA_ROWS,
) -> list[MappingRow]:
    """Mapping rows on the driver, one per destination column.

    Rows without a destination are skipped. Of several rows for one destination the newest wins,
    then the greatest path; older ones stay in Spark, so a table may have any history. More than ``max_columns``
    destination columns are an error. Flags must be BOOLEAN (null is false): a text flag would be true
    whatever it says.
    """
    for flag in (columns.retrieved, columns.confirmed):
        if not isinstance(mapping.schema[flag].dataType, T.BooleanType):
            raise TypeError(f"mapping flag {flag} must be BOOLEAN")
    wanted = [columns.dest, columns.path, columns.retrieved, columns.confirmed]
    tabled = columns.table in mapping.columns
    age = [F.col(columns.updated).cast("string")] if columns.updated in mapping.columns else []
    kept = latest_per_key(
        mapping.filter(F.col(columns.dest) != ""), [columns.dest],
        newest(*age, columns.path, columns.retrieved, columns.confirmed, *[columns.table] * tabled))
    rows = metadata_rows(kept.select(*wanted, *[columns.table] * tabled), max_columns)
    return sorted((MappingRow(
        row[columns.dest], row[columns.path], bool(row[columns.retrieved]), bool(row[columns.confirmed]),
        row[columns.table] if tabled else None) for row in rows), key=lambda r: r.dest)


def map_records(
    df: DataFrame,
    mapping: Iterable[MappingRow],
    mode: str = "reconcile",
    *,
    keep: Sequence[str] = (),
    typed: Collection[str] = (),
    filtered: Collection[str] = (),
) -> DataFrame:
    """Project records to the mapped columns: text, or VARIANT for the destinations in ``typed``.

    A destination whose flag is off for ``mode``, or whose path is empty, is left out. One whose
    path is missing in a record is null there. ``filtered`` names destinations used as keys later.
    """
    paths = {row.dest: split_path(row.path) for row in mapping if row.applies(mode)}
    return extract_paths(df, {d: p for d, p in paths.items() if p and d not in keep},
                         keep=keep, typed=typed, filtered=filtered)


def map_by_segment(df: DataFrame, mapping: Iterable[MappingRow], table: str, *, keep: Sequence[str] = ()) -> DataFrame:
    """Retrieved columns of ``table``, each named by the last step of its path."""
    paths: dict[str, list[str]] = {}
    for row in _retrieved(mapping, table):
        paths[strict_path(row.path)[-1]] = strict_path(row.path)
    return extract_paths(df, paths, keep=keep, parse_embedded=False)


def map_by_column(df: DataFrame, mapping: Iterable[MappingRow], table: str, *, keep: Sequence[str] = ()) -> DataFrame:
    """Retrieved columns of ``table``, each named by its destination."""
    paths = {row.dest: strict_path(row.path) for row in _retrieved(mapping, table)}
    return extract_paths(df, paths, keep=keep, parse_embedded=False)


@dataclass(frozen=True)
class Shapes:
    """Retrieved columns of one table under both names, from documents that are parsed once.

    ``flat`` has one column per distinct path, which ``paths`` tells; keep it where both shapes are read.
    """

    flat: DataFrame
    paths: dict[str, list[str]]
    segments: dict[str, str]
    columns: dict[str, str]
    keep: tuple[str, ...]

    def by_segment(self) -> DataFrame:
        return self._named(self.segments)

    def by_column(self) -> DataFrame:
        return self._named(self.columns)

    def joined(self, flat: DataFrame, keep: Sequence[str]) -> Shapes:
        """The shapes of rows that were joined with those of ``flat``; paths that begin with a column in ``keep`` are read there."""
        own = {name: path if path[0] in keep else [name] for name, path in self.paths.items()}
        return replace(self, flat=extract_paths(flat, own, keep=keep, parse_embedded=False), keep=tuple(keep))

    def _named(self, names: dict[str, str]) -> DataFrame:
        return self.flat.select(*self.keep, *[F.col(source).alias(name) for name, source in names.items()])


def map_shapes(df: DataFrame, mapping: Iterable[MappingRow], table: str, *, keep: Sequence[str] = ()) -> Shapes:
    """What ``map_by_segment`` and ``map_by_column`` give, from one pass over the documents."""
    rows = _retrieved(mapping, table)
    source = {path: f"__path_{i}" for i, path in enumerate(dict.fromkeys(tuple(strict_path(row.path)) for row in rows))}
    paths = {name: list(path) for path, name in source.items()}
    flat = extract_paths(df, paths, keep=keep, parse_embedded=False)
    return Shapes(
        flat, paths, {row_path[-1]: source[row_path] for row_path in (tuple(strict_path(r.path)) for r in rows)},
        {r.dest: source[tuple(strict_path(r.path))] for r in rows}, tuple(keep))


def _retrieved(mapping: Iterable[MappingRow], table: str) -> list[MappingRow]:
    return [row for row in mapping if row.retrieved and row.path and row.table == table]
