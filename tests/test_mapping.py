from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from goldthread.operators.latest import latest_per_key, newest
from goldthread.operators.mapping import (
    MappingColumns, MappingRow, compile_mapping, latest_per_column, latest_snapshot, map_by_column, map_by_segment,
    map_records, map_shapes)
from goldthread.operators.reconcile import reconcile

COLUMNS = MappingColumns(
    "RECONCILE_COLUMN_NAME", "PERSONAS_MAPPING_COLUMN_NAME", "RECONCILE_RETRIEVED", "RECONCILE_CONFIRMED", "UPDATED_DATE")
SCHEMA = ("RECONCILE_COLUMN_NAME string, PERSONAS_MAPPING_COLUMN_NAME string, RECONCILE_RETRIEVED boolean, "
          "RECONCILE_CONFIRMED boolean, UPDATED_DATE string")


def table(spark, *rows):
    return spark.createDataFrame([(*r, None)[:5] if len(r) < 5 else r for r in rows], SCHEMA)


def test_compile(spark):
    rows = compile_mapping(table(
        spark, ("SHELF", "book.shelf", True, False), ("COLOUR", "book.cover.colour", True, True),
        ("", "book.x", True, True), (None, "book.y", True, True), ("NOFLAG", "book.z", None, None)), COLUMNS)
    assert rows == [
        MappingRow("COLOUR", "book.cover.colour", True, True), MappingRow("NOFLAG", "book.z", False, False),
        MappingRow("SHELF", "book.shelf", True, False)]


def test_duplicate_destination_takes_the_newest_then_the_greatest_path(spark):
    rows = compile_mapping(table(
        spark, ("A", "p.z", True, True, None), ("A", "p.old", True, True, "2024-01-01"),
        ("A", "p.new2", False, True, "2024-02-01"), ("A", "p.new1", True, True, "2024-02-01")), COLUMNS)
    assert rows == [MappingRow("A", "p.new2", False, True)]


def test_text_flags_and_large_tables_are_refused(spark):
    mapping = table(spark, ("A", "p.a", True, True), ("B", "p.b", True, True))
    with pytest.raises(TypeError):
        compile_mapping(mapping.withColumn("RECONCILE_RETRIEVED", F.lit("false")), COLUMNS)
    with pytest.raises(ValueError):
        compile_mapping(mapping, COLUMNS, max_columns=1)
    history = table(spark, *[("A", f"p.v{i}", True, True, f"2024-01-{i:02d}") for i in range(1, 29)])
    assert compile_mapping(history, COLUMNS, max_columns=1) == [MappingRow("A", "p.v28", True, True)]


def test_snapshot_and_latest_per_column(spark):
    mapping = table(spark, ("A", "1", True, True, "2024-02-01"), ("B", "2", True, True, "2024-01-01"),
                    ("A", "3", True, True, "2024-01-01"), ("C", "4", True, True, None))
    assert {r[1] for r in latest_snapshot(mapping, COLUMNS).collect()} == {"1"}
    assert {r[1] for r in latest_per_column(mapping, COLUMNS).collect()} == {"1", "2", "4"}
    undated = mapping.withColumn("UPDATED_DATE", F.lit(None).cast("string"))
    assert latest_snapshot(undated, COLUMNS).count() == 4
    assert latest_snapshot(mapping.limit(0), COLUMNS).count() == 0


def test_map_modes(spark):
    df = spark.sql("SELECT named_struct('shelf', 'B7', 'colour', 'green') AS book")
    rows = [MappingRow("SHELF", "book.shelf", True, False), MappingRow("COLOUR", "book.colour", True, True),
            MappingRow("NOPATH", "", True, True), MappingRow("MISSING", "book.nothing", True, False)]
    assert map_records(df, rows).first().asDict() == {"SHELF": "B7", "COLOUR": "green", "MISSING": None}
    assert map_records(df, rows, "original").first().asDict() == {"COLOUR": "green"}


def test_two_shapes(spark):
    df = spark.createDataFrame([('{"memberId": "1", "email": "e"}',)], "profiles string")
    rows = [MappingRow("MEMBER", "profiles.memberId", True, True, "t"), MappingRow("MAIL", "profiles.email", True, True, "t"),
            MappingRow("OFF", "profiles.email", False, True, "t"), MappingRow("OTHER", "profiles.email", True, True, "u"),
            MappingRow("NONE", None, True, True, "t"), MappingRow("BRACKET", "profiles['email']", True, True, "t")]
    assert map_by_segment(df, rows, "t").first().asDict() == {"memberId": "1", "email": "e", "profiles['email']": None}
    assert map_by_column(df, rows, "t").first().asDict() == {"MEMBER": "1", "MAIL": "e", "BRACKET": None}
    shapes = map_shapes(df, rows, "t")
    assert shapes.by_segment().first() == map_by_segment(df, rows, "t").first()
    assert shapes.by_column().first() == map_by_column(df, rows, "t").first()


def test_both_shapes_parse_a_document_once(spark):
    df = spark.createDataFrame([('{"memberId": "1", "email": "e"}',)], "profiles string")
    rows = [MappingRow("MEMBER", "profiles.memberId", True, True, "t"), MappingRow("MAIL", "profiles.email", True, True, "t")]
    flat = map_shapes(df, rows, "t").flat
    plan = flat._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("AS __doc_") == 1  # other parses stand behind a test for odd spellings of numbers


def rows_of(df):
    return sorted((r.asDict() for r in df.collect()), key=str)


def flag(dest, retrieved):
    return MappingRow(dest, "p." + dest, retrieved, not retrieved)


def test_reconcile_prefers_by_flag(spark):
    new = spark.createDataFrame([("x1", "blue")], "item string, colour string")
    old = spark.createDataFrame([("x1", "red", "oak")], "item string, colour string, wood string")
    got = reconcile(new, old, [flag("colour", True), flag("wood", False)], "item")
    assert rows_of(got) == [{"colour": "blue", "wood": "oak", "item": "x1"}]


def test_reconcile_takes_the_first_row_of_each_side(spark):
    new = spark.createDataFrame([("1", "n1", 1), ("1", "n2", 2)], "pk string, a string, t int")
    old = spark.createDataFrame([("1", "o2", 2), ("1", "o1", 1)], "pk string, b string, t int")
    got = reconcile(new, old, [flag("a", True), flag("b", False)], "pk", new_order=["t"], old_order=["t"])
    assert rows_of(got) == [{"a": "n2", "b": "o2", "pk": "1"}]
    assert reconcile(new, old, [flag("a", True), flag("b", False)], "pk").count() == 1


def test_reconcile_presence_decides_and_not_null(spark):
    new = spark.createDataFrame([("1", None, "n", None), ("2", "x", "n", "w")], "pk string, a string, b string, c string")
    old = spark.createDataFrame([("1", "old", None, "o", "only"), ("3", "z", "z", "z", "z")],
                                "pk string, a string, b string, c string, d string")
    mapping = [flag("a", True), flag("b", False), flag("c", False), flag("d", True), flag("nowhere", True)]
    assert rows_of(reconcile(new, old, mapping, "pk")) == [
        {"a": "x", "b": "n", "c": "w", "d": None, "pk": "2"},       # no old row: the new values stand
        {"a": None, "b": None, "c": "o", "d": "only", "pk": "1"},  # null new beats old, null old beats new
    ]
    by_other_flag = reconcile(new, old, mapping, "pk", "original")
    assert {"a": "old", "b": "n", "c": None, "d": "only", "pk": "1"} in rows_of(by_other_flag)


def test_reconcile_keys(spark):
    new = spark.createDataFrame([("", "n"), (None, "n"), ("5", "n")], "pk string, a string")
    old = spark.createDataFrame([("", "o"), (None, "o")], "pk string, a string")
    assert rows_of(reconcile(new, old, [flag("a", False)], "pk")) == [{"a": "n", "pk": "5"}, {"a": "o", "pk": None}]
    mapped = reconcile(new, old, [flag("a", False), flag("pk", True)], "pk")
    assert rows_of(mapped) == [{"a": "n", "pk": "5"}, {"a": "o", "pk": ""}]
    with pytest.raises(ValueError):
        reconcile(new.drop("pk"), old, [flag("a", True)], "pk")


def test_reconcile_of_different_types_gives_text(spark):
    new = spark.createDataFrame([("1", "7"), ("2", "8")], "pk string, a string")
    old = spark.createDataFrame([("1", 5)], "pk string, a int")
    assert rows_of(reconcile(new, old, [flag("a", False)], "pk")) == [{"a": "5", "pk": "1"}, {"a": "8", "pk": "2"}]


def test_latest_per_key_orders_nulls_last_and_breaks_ties(spark):
    df = spark.createDataFrame([("a", None, 9), ("a", 1, 1), ("a", 1, 2), ("b", None, 1), (None, 3, 1), (None, 4, 1)],
                               "k string, t int, id int")
    assert rows_of(latest_per_key(df, ["k"], newest("t", "id"))) == sorted([
        {"k": "a", "t": 1, "id": 2}, {"k": "b", "t": None, "id": 1}, {"k": None, "t": 4, "id": 1}], key=str)


def test_latest_per_key_is_cut_down_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id")
    plan = latest_per_key(df, ["k"], newest("id"))._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.rindex("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in before_shuffle
