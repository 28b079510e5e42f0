"""Run a registered query and its SQL on the same tables and compare the values."""

from __future__ import annotations

import glob
import os

import duckdb


def oracle_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    result = con.execute(sql)
    return [c[0] for c in result.description], result.fetchall()


def canonical(columns, rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(row[i] for i in order) for row in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark, query, sql: str, sf_dir: str) -> int:
    df = query(spark, sf_dir)
    actual = canonical(df.columns, [tuple(r) for r in df.collect()])
    expected = canonical(*oracle_rows(sf_dir, sql))
    assert actual[0] == expected[0], (actual[0], expected[0])
    assert len(actual[1]) == len(expected[1]), (len(actual[1]), len(expected[1]), actual[1][:3], expected[1][:3])
    wrong = [(a, e) for a, e in zip(actual[1], expected[1]) if a != e]
    assert not wrong, (len(wrong), wrong[:3])
    return len(actual[1])
