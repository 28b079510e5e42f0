from __future__ import annotations

from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from goldthread.operators.cells import (
    cells_by_keys, cells_by_ranges, enrich_by_key, flatten_cells, latest_cells, of_families, read_cells, row_documents,
    row_maps, write_cells)
from goldthread.operators.changes import apply_changes, change_records
from goldthread.operators.latest import latest_per_key, newest
from goldthread.operators.keyed import cogroup_counts, cogroup_rows, drop_null_keys
from goldthread.operators.routing import attempt, split_routes
from goldthread.session import shared_dir

T0, T1 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def cell_table(spark, rows):
    return spark.createDataFrame(
        [(k, f, q, t, v if isinstance(v, bytearray) else bytearray(v.encode())) for k, f, q, t, v in rows],
        "row_key string, family string, qualifier string, ts timestamp, value binary")


def documents(spark, rows, families=("profiles",)):
    return {r.row_key: tuple(r[1:]) for r in row_documents(cell_table(spark, rows), list(families)).collect()}


def test_single_value_documents(spark):
    got = documents(spark, [
        ("object", "profiles", "value", T0, '{"a": 1.50}'), ("array", "profiles", "value", T0, "[1]"),
        ("text", "profiles", "value", T0, 'say "hi"'), ("broken", "profiles", "value", T0, "{x"),
        ("bytes", "profiles", "value", T0, bytearray(b"\xff\x00")), ("number", "profiles", "value", T0, "5"),
        ("newer", "profiles", "value", T0, '{"v": "old"}'), ("newer", "profiles", "value", T1, '{"v": "new"}')])
    assert got == {
        "object": ('{"a": 1.50}',), "array": ('{"data":[1]}',), "text": (r'{"value":"say \"hi\""}',),
        "broken": ('{"value":"{x"}',), "bytes": ('{"value":"ff00"}',), "number": ('{"value":"5"}',),
        "newer": ('{"v": "new"}',)}


def test_many_qualifiers_families_and_missing_ones(spark):
    got = documents(spark, [
        ("k", "profiles", "b", T0, "x"), ("k", "profiles", "a", T0, '{"n": 1}'), ("k", "profiles", "a", T1, "[2]"),
        ("k", "other", "value", T0, '{"o": 1}'), ("only-other", "skipped", "q", T0, "x")], ("profiles", "other"))
    assert got == {"k": ('{"a":[2],"b":"x"}', '{"o": 1}'), "only-other": ("{}", "{}")}


@pytest.mark.parametrize("broadcast_rows", [None, 0, 1000])
def test_enrich_keeps_every_event_with_a_row(spark, broadcast_rows):
    cells = cell_table(spark, [("a", "profiles", "value", T0, '{"m": 1}'), ("c", "profiles", "value", T0, '{"m": 3}')])
    events = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, k string")
    rows = enrich_by_key(events, cells, "k", broadcast_rows=broadcast_rows).orderBy("id").collect()
    assert [(r.id, r.profiles) for r in rows] == [(1, '{"m": 1}'), (2, '{"m": 1}')]


def test_bucketed_cells_are_read_by_folder(spark):
    path = shared_dir(spark, "cells")
    write_cells(cell_table(spark, [(str(k), "profiles", "value", T0, f'{{"m": {k}}}') for k in range(200)]), path, 16)
    cells = read_cells(spark, path)
    events = spark.createDataFrame([(1, "7"), (2, "7"), (3, "none")], "id int, k string")
    found = enrich_by_key(events, cells, "k")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(key_bucket" in plan or "PartitionFilters: [key_bucket" in plan
    assert sorted((r.id, r.profiles) for r in found.collect()) == [(1, '{"m": 7}'), (2, '{"m": 7}')]
    assert cells_by_keys(cells, ["1", "2"]).count() == 2


def test_events_of_a_hot_key_are_shared_by_tasks(spark):
    events = spark.range(40_000).selectExpr("id", "CASE WHEN id % 5 < 4 THEN 'hot' ELSE CAST(id AS STRING) END AS k")
    cells = spark.range(40_000).selectExpr(
        "CASE WHEN id = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS row_key", "'profiles' AS family", "'value' AS qualifier",
        "timestamp'2024-01-01' AS ts", "encode('{}', 'UTF-8') AS value")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        tasks = enrich_by_key(events, cells, "k", spread=16).groupBy(F.spark_partition_id()).count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(r["count"] for r in tasks) == 40_000
    assert max(r["count"] for r in tasks) < 0.35 * 40_000


def test_only_hot_keys_are_laid_out_more_than_once(spark):
    """Keys with nulls, without a row, hot and cold: each event is found once, whatever the spread."""
    keys = [None] * 3 + ["none"] * 9 + ["hot"] * 50 + [f"k{i % 30}" for i in range(60)]
    events = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id long, k string")
    cells = spark.createDataFrame(
        [(k, "profiles", "value", datetime(2024, 1, 1), bytearray(b'{"x":1}')) for k in ["hot", *{f"k{i}" for i in range(29)}]],
        "row_key string, family string, qualifier string, ts timestamp, value binary")
    want = sorted(i for i, k in enumerate(keys) if k not in (None, "none", "k29"))
    for spread in (1, 5, 1000):
        got = enrich_by_key(events, cells, "k", spread=spread)
        assert sorted(r.id for r in got.collect()) == want and set(got.columns) == {"id", "k", "profiles"}
    assert enrich_by_key(events.limit(0), cells, "k").count() == 0


def test_row_maps_hold_every_qualifier(spark):
    cells = cell_table(spark, [("a", "f", "q", T0, "1"), ("a", "f", "q", T1, "2"), ("a", "g", "r", T0, "3"), ("b", "g", "z", T0, "4")])
    assert {r.row_key: r.cells for r in row_maps(cells).collect()} == {"a": {"f:q": "2", "g:r": "3"}, "b": {"g:z": "4"}}
    assert {r.row_key: r.cells for r in row_maps(cells, ["f"]).collect()} == {"a": {"f:q": "2"}}


def test_key_sets_ranges_and_families(spark):
    cells = cell_table(spark, [(k, f, "q", T0, k) for k in "abcde" for f in ("f", "g")])
    assert cells_by_keys(cells, ["a", "e", "zz"]).count() == 4
    assert cells_by_keys(cells, [f"k{i}" for i in range(300)] + ["b"]).count() == 2
    keys = lambda df: sorted({r.row_key for r in df.collect()})
    assert keys(cells_by_ranges(cells, [("a", "c"), ("b", "d")])) == ["a", "b", "c"]
    assert keys(cells_by_ranges(cells, [(None, "b"), ("e", None)])) == ["a", "e"]
    assert keys(cells_by_ranges(cells, [("b", None), ("c", "d")])) == ["b", "c", "d", "e"]
    assert cells_by_ranges(cells, []).count() == 0
    assert cells_by_ranges(cells, [("a", "c"), ("a", "c")]).count() == 4
    assert of_families(cells, ["g"]).count() == 5


def test_flatten_and_latest(spark):
    cells = cell_table(spark, [("a", "f", "q", T0, "1"), ("a", "f", "q", T1, "2"), ("a", "f", "r", T0, "3"),
                               ("b", "f", "zz", T0, "4")])
    assert [r.asDict() for r in flatten_cells(cells, [("f", "q"), ("f", "none")]).collect()] == [
        {"row_key": "a", "f:q": "2", "f:none": None}]
    assert latest_cells(cells).count() == 3


def test_cogroup(spark):
    new = spark.createDataFrame([("ash", 1), ("elm", 2), (None, 3), ("ash", 4)], "k string, n int")
    old = spark.createDataFrame([("ash", "x"), ("fir", "y")], "k string, o string")
    counts = {r.k: (r.n_new, r.n_old) for r in cogroup_counts({"new": new, "old": old}, "k").collect()}
    assert counts == {"ash": (2, 1), "elm": (1, 0), "fir": (0, 1)}
    rows = cogroup_rows({"new": new, "old": old}, "k").collect()
    assert sorted((r.k, r.alias, r.new and r.new.n, r.old and r.old.o) for r in rows) == sorted([
        ("ash", "new", 1, None), ("ash", "new", 4, None), ("elm", "new", 2, None), ("ash", "old", None, "x"),
        ("fir", "old", None, "y")])
    assert drop_null_keys(new, "k").count() == 3


@pytest.mark.parametrize("broadcast_rows", [None, 0, 100])
def test_apply_changes(spark, broadcast_rows):
    current = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    changes = spark.createDataFrame(
        [("a", 10, "UPSERT", 1), ("a", 11, "UPSERT", 2), ("b", None, "DELETE", 1), ("d", 4, "UPSERT", 1),
         ("e", 5, "UPSERT", 1), ("e", 5, "DELETE", 2)], "k string, v int, _CHANGE_TYPE string, seq int")
    got = apply_changes(current, changes, ["k"], ["seq"], broadcast_rows)
    assert sorted((r.k, r.v) for r in got.collect()) == [("a", 11), ("c", 3), ("d", 4)]


def test_changes_of_a_null_or_compound_key(spark):
    current = spark.createDataFrame([(None, "x", 1), ("a", "x", 2), ("a", "y", 3)], "k string, l string, v int")
    changes = spark.createDataFrame([(None, "x", 7, "UPSERT", 1), ("a", "y", None, "DELETE", 1)],
                                    "k string, l string, v int, _CHANGE_TYPE string, seq int")
    got = apply_changes(current, changes, ["k", "l"], ["seq"]).collect()
    assert {tuple(r) for r in got} == {(None, "x", 7), ("a", "x", 2)}


def test_few_changes_do_not_shuffle_the_table(spark):
    current = spark.range(1000).selectExpr("CAST(id AS STRING) AS k", "id AS v")
    changes = spark.range(10).selectExpr("CAST(id AS STRING) AS k", "id AS v", "'UPSERT' AS _CHANGE_TYPE", "id AS seq")
    plan = apply_changes(current, changes, ["k"], ["seq"], 100)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_change_records(spark):
    df = spark.createDataFrame([("q7", "tall")], "plant string, size string")
    row = change_records(df, at=F.lit("2024-01-02 03:04:05").cast("timestamp")).first()
    assert row.record.asDict() == {"plant": "q7", "size": "tall", "_CHANGE_TYPE": "UPSERT"}
    assert row.row_mutation_info.asDict() == {"change_type": "UPSERT", "timestamp": "2024-01-02T03:04:05.000000Z"}


def test_routes_conserve_messages(spark):
    messages = spark.createDataFrame(
        [(str(i), bytearray(b"x" if i % 3 else b"y"), {"retry_count": str(i % 5)} if i % 7 else {}) for i in range(60)],
        "message_id string, data binary, attributes map<string,string>")

    def process(df):
        bad = F.col("data") == F.lit(b"y")
        return df.withColumns({"result": F.when(~bad, "done"), "error": F.when(bad, "no")})

    attempted = attempt(messages, process, max_retries=3)
    routes = split_routes(attempted)
    tries = lambda i: i % 5 if i % 7 else 0
    assert routes.success.count() == 40
    assert {(r.message_id, r.retry_count) for r in routes.retry.collect()} == {
        (str(i), tries(i) + 1) for i in range(0, 60, 3) if tries(i) < 3}
    dead = routes.dead.collect()
    assert {(r.message_id, r.retry_count) for r in dead} == {(str(i), tries(i)) for i in range(0, 60, 3) if tries(i) >= 3}
    assert all(r.final_failure and r.error == "no" for r in dead)


def test_routing_takes_a_pandas_function(spark):
    @F.pandas_udf("result string, error string")
    def work(data: pd.Series) -> pd.DataFrame:
        good = data.map(lambda raw: bytes(raw).isdigit())
        return pd.DataFrame({"result": data.map(lambda raw: bytes(raw).decode()).where(good),
                             "error": pd.Series("not a number", index=data.index).where(~good)})

    messages = spark.createDataFrame(
        [("a", bytearray(b"12"), None), ("b", bytearray(b"x"), {"retry_count": "3"})],
        "message_id string, data binary, attributes map<string,string>")
    attempted = attempt(messages, lambda df: df.withColumn("out", work("data")).select("*", "out.*").drop("out"))
    routes = split_routes(attempted)
    assert [tuple(r) for r in routes.success.collect()] == [("a", "12")]
    assert [r.message_id for r in routes.dead.collect()] == ["b"] and routes.retry.count() == 0


def test_one_key_with_most_rows_leaves_each_task_as_one_row(spark):
    """A member with two thirds of all versions: what is shuffled is bounded by the number of tasks."""
    df = spark.range(0, 90_000, 1, 8).selectExpr("CASE WHEN id % 3 < 2 THEN 'hot' ELSE CAST(id AS STRING) END AS k", "id")
    got = latest_per_key(df, ["k"], newest("id"))
    assert got.count() == 30_001
    assert got.filter("k = 'hot'").first().id == 89_998
    counts = cogroup_counts({"new": df, "old": df.filter("id < 10")}, "k").filter("k = 'hot'").first()
    assert (counts.n_new, counts.n_old) == (60_000, 7)
