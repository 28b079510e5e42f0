from __future__ import annotations

import json
from datetime import datetime, timezone

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from goldthread.functions.calendar import (
    drop_window_columns, partition_columns, with_run_partitions, with_run_partitions_from_text, with_window_path)
from goldthread.functions.extract import extract_paths, with_json_value
from goldthread.operators.cells import cell_json
from goldthread.operators.normalize import parse_json_fields
from goldthread.plans.batch import write_run
from goldthread.session import shared_dir
from goldthread.sources import readers, sinks, state
from goldthread.streaming.sinks import compact_batches, write_batch


@pytest.fixture
def table(spark):
    name = f"t_{shared_dir(spark, 'x')[-12:]}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def people(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, v bigint")


def content(df):
    return sorted(tuple(r) for r in df.collect())


def test_query_source(spark):
    got = readers.read_query(
        spark, "SELECT k FROM IDENTIFIER(:t) WHERE v > :low", {"t": "people", "low": 1},
        {"people": people(spark, ("a", 1), ("b", 2))})
    assert content(got) == [("b",)]
    for query in ("", "  ", "SELECT * FROM {table}"):
        with pytest.raises(ValueError):
            readers.read_query(spark, query)


def test_write_table_modes(spark, table):
    with pytest.raises(ValueError):
        sinks.write_table(people(spark, ("a", 1)), table, create=False)
    sinks.write_table(people(spark, ("a", 1)), table)
    more = people(spark, ("b", 2)).select("v", F.col("k").alias("K")).withColumn("unknown", F.lit(1))
    with pytest.raises(ValueError, match="unknown"):
        sinks.write_table(more, table, create=False)
    sinks.write_table(more, table, create=False, ignore_unknown=True)
    assert content(spark.table(table)) == [("a", 1), ("b", 2)]
    with pytest.raises(ValueError):
        sinks.write_table(people(spark, ("c", 3)), table, "empty")
    sinks.write_table(people(spark, ("c", 3)).drop("v"), table, "truncate")
    assert content(spark.table(table)) == [("c", None)]
    with pytest.raises(ValueError):
        sinks.write_table(people(spark, ("c", 3)), table, "merge")


def test_swap_reads_its_own_table_and_recovers(spark, table):
    sinks.write_table(people(spark, ("a", 1)), table)
    sinks.swap_table(spark.table(table).withColumn("v", F.col("v") + 1), table)
    assert content(spark.table(table)) == [("a", 2)]
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}{sinks.PREVIOUS}")  # as a run that died in between leaves it
    changes = people(spark, ("b", 5)).withColumn("_CHANGE_TYPE", F.lit("UPSERT")).withColumn("seq", F.lit(1))
    sinks.upsert_table(changes, table, ["k"], ["seq"])
    assert content(spark.table(table)) == [("a", 2), ("b", 5)]
    assert not spark.catalog.tableExists(table + sinks.PREVIOUS)


def test_run_folder(spark):
    path = shared_dir(spark, "run")
    at = datetime(2024, 1, 31, 18, 30, tzinfo=timezone.utc)
    write_run(people(spark, ("a", 1), ("b", 2)), path, at)
    write_run(people(spark, ("c", 3)), path, at)
    write_run(people(spark, ("d", 4)), path, datetime(2024, 2, 1, 18, 30))
    folder = f"{path}/par_month=202402/par_day=01/par_hour=01/run_dt=2024020101"
    assert content(spark.read.parquet(folder)) == [("c", 3)]
    assert spark.read.parquet(path).count() == 2


def test_run_partitions_from_text(spark):
    df = people(spark, ("a", 1))
    from_text = with_run_partitions_from_text(df, "2024020101", "MM").first().asDict()
    assert from_text == with_run_partitions(df, datetime(2024, 1, 31, 18, 59), "MM").first().asDict()
    assert (from_text["par_month"], from_text["par_day"], from_text["par_hour"]) == ("02", "01", "01")


def test_window_path_crosses_the_day(spark):
    df = spark.sql("SELECT timestamp'2024-01-31 16:55:00' AS ts UNION ALL SELECT timestamp'2024-01-31 16:54:59'")
    rows = with_window_path(df, "ts").orderBy("ts").collect()
    assert [r["_window_path"] for r in rows] == [
        "par_month=01/par_day=31/par_hour=23/run_dt=2024013123", "par_month=02/par_day=01/par_hour=00/run_dt=2024020100"]
    assert rows[1]["_window_timestamp"] == datetime(2024, 2, 1, 0, 0)
    assert drop_window_columns(with_window_path(df, "ts")).columns == ["ts"]


def test_shards_and_codec(spark):
    path = shared_dir(spark, "shards")
    sinks.write_parquet(spark.range(100), path, shards=7)
    files = spark.read.parquet(path).select("_metadata.file_name").distinct().collect()
    assert len(files) == 7 and all(r[0].endswith(".snappy.parquet") for r in files)


def test_lines(spark):
    df = people(spark, ("a", 1), ("b", None))
    text, json_path = shared_dir(spark, "text"), shared_dir(spark, "json")
    sinks.write_lines(df.select("k"), text)
    assert content(readers.read_text_lines(spark, text)) == [("a",), ("b",)]
    sinks.write_lines(df, json_path, "json")
    assert content(readers.read_json_lines(spark, json_path, "k string, v bigint")) == [("a", 1), ("b", None)]
    lines = [json.loads(r.value) for r in readers.read_text_lines(spark, json_path).collect()]
    assert {"k": "b", "v": None} in lines
    with pytest.raises(ValueError):
        sinks.write_lines(df, text, "csv")


def test_state_is_one_row_in_one_file(spark):
    path = shared_dir(spark, "state")
    sinks.write_state(people(spark, ("a", 1)), path)
    written = readers.read_text_lines(spark, path)
    assert [json.loads(r.value) for r in written.collect()] == [{"k": "a", "v": 1}]
    with pytest.raises(ValueError):
        sinks.write_state(people(spark, ("a", 1), ("b", 2)), path)


def test_dead_letters_keep_their_bytes(spark):
    dead = spark.createDataFrame([("t", bytearray(b"x")), ("b", bytearray(b"\xff\xfe{")), ("n", None)], "id string, data binary")
    got = {d["id"]: d for d in (json.loads(r[0]) for r in sinks.dead_letter_lines(dead).collect())}
    assert (got["t"]["data"], got["t"]["data_encoding"]) == ("x", "utf-8")
    assert (got["b"]["data"], got["b"]["data_encoding"]) == ("//57", "base64")
    assert got["n"].get("data") is None and got["n"].get("data_encoding") is None


def test_bucketed_upsert_leaves_other_folders_alone(spark):
    path = shared_dir(spark, "buckets")
    sinks.write_buckets(people(spark, *[(f"k{i}", i) for i in range(100)]), path, ["k"], 8)
    files = lambda: {r[0] for r in spark.read.parquet(path).select("_metadata.file_path").distinct().collect()}
    before = files()
    change = lambda k, v, kind: people(spark, (k, v)).withColumns({"_CHANGE_TYPE": F.lit(kind), "seq": F.lit(1)})
    sinks.upsert_buckets(change("k5", 500, "UPSERT").union(change("new", 7, "UPSERT")).union(change("k6", None, "DELETE")),
                         path, ["k"], ["seq"], 8)
    assert content(sinks.read_buckets(spark, path)) == sorted(
        [(f"k{i}", i) for i in range(100) if i not in (5, 6)] + [("k5", 500), ("new", 7)])
    assert len(before & files()) >= 5


def test_a_bucket_may_lose_all_its_rows(spark):
    path = shared_dir(spark, "buckets")
    sinks.write_buckets(people(spark, ("a", 1)), path, ["k"], 4)
    gone = people(spark, ("a", None)).withColumns({"_CHANGE_TYPE": F.lit("DELETE"), "seq": F.lit(1)})
    sinks.upsert_buckets(gone, path, ["k"], ["seq"], 4)
    assert sinks.read_buckets(spark, path).count() == 0


def test_swap_keeps_the_layout(spark, table):
    spark.sql(f"CREATE TABLE {table} (k STRING COMMENT 'the key', v BIGINT) USING parquet PARTITIONED BY (k)")
    sinks.write_table(people(spark, ("a", 1)), table)
    sinks.swap_table(people(spark, ("b", 2)), table)
    assert content(spark.table(table).select("k", "v")) == [("b", 2)]
    columns = {c.name: c for c in spark.catalog.listColumns(table)}
    assert columns["k"].isPartition and columns["k"].description == "the key"


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_folders_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        df = spark.sql("SELECT timestamp'2024-03-09 19:30:00Z' AS ts")  # 02:30 on a day that has no such time in New York
        row = df.select(*[v.alias(n) for n, v in partition_columns(F.col("ts")).items()]).first()
        path = with_window_path(df, "ts").first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(row) == ("202403", "10", "02", "2024031002")
    assert path["_window_path"] == "par_month=03/par_day=10/par_hour=02/run_dt=2024031002"


def test_a_mark_that_cannot_be_read_is_an_error(spark):
    path = shared_dir(spark, "mark")
    assert str(state.read_mark(spark, path).first().mark) == state.NO_MARK
    spark.createDataFrame([("x",)], "mark string").write.parquet(path)
    with pytest.raises(Exception):
        state.read_mark(spark, path).collect()


def test_compaction_keeps_the_rows(spark):
    path, target = shared_dir(spark, "batches"), shared_dir(spark, "compacted")
    for batch in (0, 1, 1):
        write_batch(people(spark, (f"b{batch}", batch)), path, batch, ["k"])
    compact_batches(spark, path, target, ["k"])
    assert content(spark.read.parquet(target).select("k", "v")) == [("b0", 0), ("b1", 1)]


def test_a_replay_leaves_no_stale_folder(spark):
    path = shared_dir(spark, "replayed")
    write_batch(people(spark, ("first", 1), ("both", 2)), path, 4, ["k"])
    write_batch(people(spark, ("both", 3)), path, 4, ["k"])
    assert content(spark.read.parquet(path).select("k", "v")) == [("both", 3)]


def test_schema_sources(spark, table):
    path = shared_dir(spark, "schema")
    text = '[\n {"name": "a", "type": "DATE"},\n {"name": "b", "type": "FLOAT64"}, {"name": "c"}]'
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    assert readers.schema_of_source(spark, json_file=path, query="SELECT 1 AS x").simpleString() == \
        "struct<a:date,b:double,c:string>"
    query = "SELECT 1 AS i, timestamp'2024-01-01' AS t, array(1) AS l, 1.5BD AS d"
    assert readers.schema_of_source(spark, query=query, table=table).simpleString() == \
        "struct<i:bigint,t:timestamp_ntz,l:string,d:decimal(38,9)>"
    sinks.write_table(people(spark, ("a", 1)), table)
    assert readers.schema_of_source(spark, table=table).simpleString() == "struct<k:string,v:bigint>"
    with pytest.raises(ValueError):
        readers.schema_of_source(spark)
    with pytest.raises(AnalysisException):
        readers.schema_of_source(spark, table="no_such_table")


def test_high_water_mark(spark):
    path = shared_dir(spark, "mark")
    events = spark.sql("SELECT explode(sequence(timestamp_ntz'2024-01-01', timestamp_ntz'2024-01-05', interval 1 day)) AS ts")
    assert state.newer_than_mark(events, "ts", state.read_mark(spark, path)).count() == 5
    state.save_mark(events.filter("day(ts) <= 3"), "ts", path)
    state.save_mark(events.limit(0), "ts", path)
    assert state.newer_than_mark(events, "ts", state.read_mark(spark, path)).count() == 2
    assert state.read_mark(spark, path).first().mark == datetime(2024, 1, 3)


def test_snapshot_load(spark, table):
    path = shared_dir(spark, "source")
    people(spark, ("a", 1)).write.parquet(path)
    sinks.load_snapshot(spark, path, table)
    people(spark, ("b", 2)).write.mode("overwrite").parquet(path)
    sinks.load_snapshot(spark, path, table)
    assert content(spark.table(table)) == [("b", 2)]


def test_exists_and_parse_json(spark):
    df = people(spark, ("a", 1))
    assert sinks.record_exists(df, "k", "a") and not sinks.record_exists(df, "k", "z")
    docs = spark.createDataFrame([('{"a": 1}',), ("{bad",), (None,)], "profiles string")
    got = parse_json_fields(docs, ["profiles", "not_there"]).select(F.to_json("profiles")).collect()
    assert [r[0] for r in got] == ['{"a":1}', '"{bad"', None]


WHOLE = ['{"a": 1}', ' {"a":{"b":[1,{}]}}\n', "[1,2]", "12", "-1.5e3", "true", "null", '"x, \\"y\\": {"', '"é"', " 7 "]
BROKEN = ['{"a":1}{"b":2}', '{"a":1},{"b":2}', '{"a":1}\n{"b":2}', '{"a":1}x', '{"a":1,}', "1,2", '1,"w":2', '"a","w":"b"', "[1][2]", "", "  ", "{", "tru",
          '"open', "}", "{},", '{"a":1}}', "nul l"]


def test_json_is_one_whole_value(spark):
    """Nothing behind a first value is overlooked: such text is no JSON and stays text."""
    docs = spark.createDataFrame([(t,) for t in WHOLE + BROKEN], "profiles string")
    got = parse_json_fields(docs).select(F.to_json("profiles").alias("x")).collect()
    for text, row in zip(WHOLE + BROKEN, got):
        assert json.loads(row.x) == (json.loads(text) if text in WHOLE else text)
    cells = docs.select(cell_json(F.col("profiles").cast("binary")).alias("x")).collect()
    for text, row in zip(WHOLE + BROKEN, cells):
        whole = text in WHOLE and text[:1] in "[{"
        assert json.loads(row.x) == (json.loads(text) if whole else text)


def test_two_objects_in_a_text_are_none(spark):
    docs = spark.createDataFrame([('{"a":1}{"b":2}',), ('{"a":{"c":"x"}}{"a":{"c":"y"}}',), ('{"a":{"c":"z"}} ',), ('{"a":"{\\"c\\":1}{\\"c\\":2}"}',)], "doc string")
    got = [r.v for r in with_json_value(docs, "v", F.col("doc"), ("a", "c")).collect()]
    assert got == [None, None, "z", None]
    found = extract_paths(docs, {"deep": ["doc", "a", "c"], "top": ["doc", "a"]})
    assert [(r.deep, r.top) for r in found.collect()] == [(None, None), (None, None), ("z", '{"c":"z"}'), (None, '{"c":1}{"c":2}')]


def test_json_lines_with_more_than_one_value_are_an_error(spark):
    path = shared_dir(spark, "lines")
    spark.createDataFrame([('{"k":"a","v":1}',), ("",), ('{"v":2}',)], "value string").coalesce(1).write.text(path)
    assert {tuple(r) for r in readers.read_json_lines(spark, path, "k string, v bigint").collect()} == {("a", 1), (None, 2)}
    assert sorted(r[0] for r in readers.read_json_lines(spark, path).select(F.to_json("value")).collect()) == ['{"k":"a","v":1}', '{"v":2}']
    for line in ('{"k":"a"}{"k":"b"}', '{"k":"a"},{"k":"b"}', "{", '{"v":"x"}'):
        bad = shared_dir(spark, "lines")
        spark.createDataFrame([(line,)], "value string").write.text(bad)
        with pytest.raises(Exception, match="(?i)malformed|parse"):
            readers.read_json_lines(spark, bad, "k string, v bigint").collect()
        if line != '{"v":"x"}':
            with pytest.raises(Exception, match="not one JSON value"):
                readers.read_json_lines(spark, bad).collect()


def test_scratch_lies_in_a_shared_folder(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))

    class Unset:
        conf = type("C", (), {"get": lambda self, key, *_: "/shared/warehouse" if "warehouse" in key else None})()

    assert shared_dir(Unset(), "x").startswith("/shared/warehouse/x-")
