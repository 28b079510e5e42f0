"""The jobs on hand-made tables."""

from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldthread.operators.cells import key_counts
from goldthread.operators.mapping import MappingRow
from goldthread.operators.sizing import fits
from goldthread.plans.batch import BatchJob, backfill, incremental, run_since_mark
from goldthread.session import shared_dir
from goldthread.sources.state import newer_than_mark, newest_value, read_mark, save_mark
from goldthread.streaming.messages import MESSAGE_SCHEMA, deduplicate, event_keys, file_messages, from_queue_records
from goldthread.streaming.realtime import RealtimeJob, look_up, run_batch, start_realtime
from goldthread.streaming.refresh import MappingRefresh
from goldthread.streaming.sinks import start_window_files

MAPPING = ("dest string, path string, retrieved boolean, confirmed boolean, updated_date string, table_name string")
SCHEMA = T.StructType([
    T.StructField("member_number", T.StringType()), T.StructField("email", T.StringType()),
    T.StructField("phone", T.StringType()), T.StructField("age", T.LongType()), T.StructField("born", T.DateType()),
    T.StructField("active", T.BooleanType()), T.StructField("seen", T.TimestampNTZType())])
NOW = datetime(2024, 1, 10, 12)


def mapping(spark, **changed):
    paths = {"member_number": "profiles.memberId", "email": "profiles.email", "phone": "profiles.phone",
             "age": "profiles.age", "born": "profiles.born", "active": "profiles.flags.active", **changed}
    return spark.createDataFrame(
        [(d, p, d != "phone", True, "2024-01-01", "ms_member") for d, p in paths.items()], MAPPING)


def personas(spark):
    return spark.createDataFrame([
        (1, '{"memberId": "a", "email": "old"}', datetime(2024, 1, 10, 11)),
        (2, '{"memberId": "a", "age": 41.9, "born": "1/2/1990", "flags": "{\\"active\\": 1}"}', NOW),
        (3, '{"memberId": "b", "phone": "new", "age": "41.9"}', datetime(2024, 1, 10, 10)),
        (4, '{"memberId": "", "email": "blank"}', NOW),
        (5, '{"email": "nobody", "alias": "z"}', NOW),
        (6, "{broken", NOW),
        (7, '{"memberId": "late"}', datetime(2024, 1, 10, 9, 59, 59)),
        (8, '{"memberId": "future"}', datetime(2024, 1, 11)),
        (9, '{"memberId": {"nested": 1}}', NOW)], "id int, profiles string, timestamp timestamp")


def members(spark):
    return spark.createDataFrame([
        ("a", "a@x", "1", 30, "1980-01-01", datetime(2024, 1, 1), datetime(2024, 1, 1, 5)),
        ("a", "older", "0", 29, "1980-01-01", datetime(2023, 1, 1), None),
        ("b", "b@x", None, 50, "05/06/1970", datetime(2024, 1, 1), None),
        ("gone", "g@x", "9", 9, "1980-01-01", datetime(2024, 1, 1), None)],
        "member_number string, email string, phone string, age int, born string, updated_date timestamp, seen timestamp_ntz")


JOB = BatchJob(SCHEMA, persona_order=("timestamp", "id"))


def rows(df):
    return {r.member_number: tuple(r)[1:] for r in df.collect()}


A_ROW = ("", "1", 41, date(1990, 2, 1), True, None)


def test_backfill(spark):
    got = rows(backfill(personas(spark), members(spark), mapping(spark), JOB, F.lit(NOW)))
    assert got == {"a": A_ROW, "b": ("", "", None, None, None, None), "late": ("", "", None, None, None, None)}


@pytest.mark.parametrize("broadcast_rows", [None, 0, 1000])
def test_incremental(spark, broadcast_rows):
    got = rows(incremental(
        personas(spark), members(spark), mapping(spark), JOB, F.lit(NOW), broadcast_rows=broadcast_rows))
    assert got == {"a": A_ROW, "b": ("", "", None, None, None, None), "": ("blank", "", None, None, None, None)}


def test_key_from_another_path_keeps_one_row_per_key(spark):
    """The member id ranks the personas, the mapped key joins them."""
    got = rows(incremental(
        personas(spark), members(spark), mapping(spark, member_number="profiles.alias"), JOB, F.lit(NOW),
        broadcast_rows=None))
    # Of the personas without a member id only the newest is left (id 9 has an object as its id).
    assert got == {}
    some = personas(spark).filter("id IN (2, 5)")
    got = rows(incremental(some, members(spark), mapping(spark, member_number="profiles.alias"), JOB, F.lit(NOW)))
    assert got == {"z": ("nobody", "", None, None, None, None)}
    with pytest.raises(ValueError):
        rows(backfill(some, members(spark), mapping(spark, member_number=""), JOB, F.lit(NOW)))


def test_runs_from_a_mark(spark):
    """Each run takes what is newer than the last one's newest row; the mark is raised behind the write only."""
    mark, path = shared_dir(spark, "mark"), shared_dir(spark, "runs")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SCHEMA.fields) + ", run_dt string"

    def run(ids, hour, job=JOB):
        run_since_mark(personas(spark).filter(F.col("id").isin(ids)), members(spark), mapping(spark), job, mark, path, datetime(2024, 1, 20, hour))
        found = spark.read.schema(kinds).parquet(path).filter(F.col("run_dt") == f"20240120{hour + 7:02}").collect()
        return {r.member_number: r.email for r in found}

    assert run([1, 3, 7], 1) == {"a": "old", "b": "", "late": ""}
    # What is not newer than the mark was seen; without newer rows there is no folder and the mark stays.
    assert run([1, 3, 7], 2) == {} and run([2, 3, 7, 4], 3) == {"a": "", "": "blank"}

    def fails(df):
        raise RuntimeError("a step fails")

    with pytest.raises(RuntimeError):
        run([2, 8], 4, BatchJob(SCHEMA, persona_order=("timestamp", "id"), steps=(fails,)))
    assert run([2, 8], 5) == {"future": ""} and run([2, 8], 6) == {}


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_a_mark_holds_in_every_zone(spark, kind):
    path = shared_dir(spark, "mark")
    conf, before = spark.conf, spark.conf.get("spark.sql.session.timeZone")
    rows = spark.range(5).select("id", (F.timestamp_micros(F.lit(1_704_067_200_000_001) + F.col("id") * 3_600_000_000)).alias("ts"))
    if kind == "timestamp_ntz":
        rows = spark.range(5).selectExpr("id", "timestampadd(HOUR, id, TIMESTAMP_NTZ'2024-01-01 00:00:00') AS ts")
    try:
        save_mark(rows.filter("id <= 2"), "ts", path)
        for zone in ("Asia/Tokyo", "America/New_York", "UTC"):
            conf.set("spark.sql.session.timeZone", zone)
            assert [r.id for r in newer_than_mark(rows, "ts", read_mark(spark, path)).collect()] == [3, 4]
            assert rows.filter(F.col("ts") <= newest_value(rows, "ts")).count() == 5
            save_mark(rows.filter("id <= 2"), "ts", path)
    finally:
        conf.set("spark.sql.session.timeZone", before)
    assert newest_value(rows.limit(0), "ts") is None


def test_what_fits_is_counted_in_rows_and_bytes(spark):
    rows = spark.range(100).select(F.repeat(F.lit("é"), 50).alias("k"), F.struct(F.lit("x").alias("y")).alias("s"))
    assert fits(rows, 100) and not fits(rows, 99) and fits(rows.limit(0), 0)
    assert not fits(rows, 100, 12_000) and fits(rows, 100, 17_000)


def test_backfill_join_needs_one_shuffle_per_side(spark):
    plan = backfill(personas(spark), members(spark), mapping(spark), JOB, F.lit(NOW))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 2


def message(key, i, at, data=None):
    body = data if data is not None else '{"payload": {"personaId": "%s"}}' % key
    return (f"m{i}", at, bytearray(body if isinstance(body, bytes) else body.encode()), {})


def cells(spark, documents):
    return spark.createDataFrame(
        [(k, "profiles", "value", NOW, bytearray(d.encode())) for k, d in documents.items()],
        "row_key string, family string, qualifier string, ts timestamp, value binary")


def test_event_keys(spark):
    rows = [message("k", 1, NOW), message("", 2, NOW), message("", 3, NOW, "{bad"), message("", 4, NOW, "{}"),
            message("", 5, NOW, b"\xff\xfe"), message("", 6, NOW, '{"payload": "text"}'),
            message("", 7, NOW, '{"payload": {"personaId": null}}'), message("", 8, NOW, '{"payload": {"personaId": 7}}')]
    got = event_keys(spark.createDataFrame(rows, MESSAGE_SCHEMA)).collect()
    assert {(r.message_id, r.persona_id) for r in got} == {("m1", "k"), ("m8", "7")}


def realtime_tables(spark):
    rows, files, dead = (shared_dir(spark, n) for n in ("rows", "files", "dead"))
    return RealtimeJob(rows, files, "ms_member", dead, table_columns=("memberId", "email", "x"))


def test_realtime_batch_and_replay(spark):
    job = realtime_tables(spark)
    rows = MappingRefresh(lambda: mapping(spark)).current()
    docs = cells(spark, {"k1": '{"memberId": "1", "email": {"a": 1}}', "k2": '{"memberId": "  "}', "k3": '{"email": "e"}'})
    batch = spark.createDataFrame(
        [message("k1", 1, NOW), message("k1", 2, NOW), message("k2", 3, NOW), message("k3", 4, NOW),
         message("none", 5, NOW), message("", 6, NOW, "{bad")], MESSAGE_SCHEMA)
    for _ in range(2):  # the second run is a replay of the same batch
        run_batch(batch, 0, docs, rows, job)
    table = spark.read.parquet(job.table_path).drop("batch_id").collect()
    assert [r.asDict() for r in table] == [{"memberId": "1", "email": '{"a":1}', "x": None}] * 2
    files = spark.read.parquet(job.files_path)
    assert files.count() == 2
    assert set(files.columns) == {"active", "age", "born", "email", "member_number", "phone", "par_month", "par_day",
                                  "par_hour", "run_dt", "batch_id"}
    assert files.first().member_number == "1" and files.first().phone is None
    assert spark.read.parquet(job.dead_letter_path).count() == 1


def test_realtime_fixed_file_schema_and_required_column(spark):
    schema = T.StructType([T.StructField("member_number", T.StringType()), T.StructField("age", T.LongType()),
                           T.StructField("extra", T.StringType()), T.StructField("born", T.DateType())])
    base = realtime_tables(spark)
    job = RealtimeJob(base.table_path, base.files_path, "ms_member", base.dead_letter_path,
                      table_columns=("email", "memberId"), required="email", file_schema=schema)
    docs = cells(spark, {"k1": '{"memberId": "1", "age": 5, "born": "2024-01-02"}'})
    run_batch(spark.createDataFrame([message("k1", 1, NOW)], MESSAGE_SCHEMA), 3, docs,
              MappingRefresh(lambda: mapping(spark)).current(), job)
    row = spark.read.parquet(job.files_path).first().asDict()
    assert (row["member_number"], row["age"], row["extra"], row["born"]) == ("1", 5, None, date(2024, 1, 2))
    assert spark.read.schema("email string, memberId string").parquet(job.table_path).count() == 0
    assert spark.read.parquet(job.dead_letter_path).filter("value LIKE '%required%'").count() == 1


def test_realtime_documents_are_parsed_once_per_key(spark):
    """Many messages ask for two rows: the documents are turned into values before the messages meet them."""
    job = realtime_tables(spark)
    rows = MappingRefresh(lambda: mapping(spark)).current()
    docs = cells(spark, {"k1": '{"memberId": "1", "email": "e"}', "k2": '{"memberId": "2"}', "k3": '{"memberId": " "}'})
    keyed = event_keys(spark.createDataFrame([message(f"k{i % 4}", i, NOW) for i in range(400)], MESSAGE_SCHEMA))
    found = look_up(key_counts(keyed, "persona_id"), docs, rows, job)
    assert sorted(r.persona_id for r in found.flat.collect()) == ["k1", "k2"]
    joined = found.joined(keyed.join(found.flat, "persona_id"), ["message_id"])
    assert joined.flat.count() == 200
    assert {tuple(r) for r in joined.by_segment().select("memberId", "email").collect()} == {("1", "e"), ("2", None)}


def test_realtime_a_written_message_is_no_dead_letter(spark):
    """Two messages of one id with different keys, of which one row lacks the required column."""
    base = realtime_tables(spark)
    job = RealtimeJob(base.table_path, base.files_path, "ms_member", base.dead_letter_path,
                      table_columns=("email", "memberId"), required="email")
    docs = cells(spark, {"k1": '{"memberId": "1", "email": "e"}', "k2": '{"memberId": "2"}'})
    batch = spark.createDataFrame([message("k1", 1, NOW), message("k2", 1, NOW), message("k2", 2, NOW), message("", 3, NOW, "{}")],
                                  MESSAGE_SCHEMA)
    run_batch(batch, 0, docs, MappingRefresh(lambda: mapping(spark)).current(), job)
    assert [r.email for r in spark.read.parquet(job.table_path).collect()] == ["e"]
    dead = [json.loads(r.value) for r in spark.read.parquet(job.dead_letter_path).select("value").collect()]
    assert sorted((d["message_id"], d.get("persona_id"), d["error"]) for d in dead if d["message_id"] != "m3") == [
        ("m1", "k2", "a required column is null"), ("m2", "k2", "a required column is null")]
    assert [d["error"] for d in dead if d["message_id"] == "m3"] == ["no key in the message"]


@pytest.mark.parametrize("required, refused", [("message_id", 0), ("publish_time", 1), ("stamp", 1), ("nowhere", 2), ("memberId", 0)])
def test_realtime_paths_of_the_message(spark, required, refused):
    """A column that is read from the message, and required ones from there, from the document and from nowhere."""
    base = realtime_tables(spark)
    job = RealtimeJob(base.table_path, base.files_path, "ms_member", base.dead_letter_path,
                      table_columns=("persona_id", "memberId", "stamp", "nowhere"), required=required)
    rows = [MappingRow(dest, path, True, True, "ms_member") for dest, path in (
        ("member", "profiles.memberId"), ("key", "persona_id"), ("stamped", "message_id.stamp"))]
    docs = cells(spark, {"k1": '{"memberId": "1"}'})
    batch = spark.createDataFrame([message("k1", 1, NOW), message("k1", 2, None)], MESSAGE_SCHEMA)
    batch = batch.withColumn("message_id", F.when(F.col("message_id") == "m1", '{"stamp": "s"}').otherwise("m2"))
    run_batch(batch, 0, docs, rows, job)
    files = spark.read.parquet(job.files_path).select("member", "key", "stamped").collect()
    assert [tuple(r) for r in files] == [("1", "k1", "s")]  # a message without a time has no window
    table = spark.read.schema("persona_id string, memberId string, stamp string").parquet(job.table_path)
    assert sorted(r.stamp or "" for r in table.collect()) == ["", "s"][refused:] if required != "nowhere" else table.count() == 0
    dead = spark.read.schema("value string").parquet(job.dead_letter_path)
    assert dead.filter("value LIKE '%required%'").count() == refused


def test_mapping_refresh_keeps_the_last_good_rows(spark):
    now, reads = [0.0], []

    def read():
        reads.append(now[0])
        if now[0] == 60.0:
            raise RuntimeError("not reachable")
        return mapping(spark, email=f"profiles.email{int(now[0])}")

    refresh = MappingRefresh(read, interval=60.0, clock=lambda: now[0])
    email = lambda: next(r.path for r in refresh.current() if r.dest == "email")
    seen = []
    for at in (0.0, 59.0, 60.0, 61.0, 62.0):
        now[0] = at
        seen.append(email())
    assert seen == ["profiles.email0"] * 3 + ["profiles.email61"] * 2
    assert reads == [0.0, 60.0, 61.0]

    def broken():
        raise RuntimeError("never reachable")

    with pytest.raises(RuntimeError):
        MappingRefresh(broken).current()


def test_queue_records(spark):
    records = spark.createDataFrame(
        [(bytearray(b"x"), "t", 1, 7, NOW, [("message_id", bytearray(b"id1")), ("publish_time", bytearray(b"2024-01-01 00:00:00"))]),
         (bytearray(b"y"), "t", 2, 8, NOW, None)],
        "value binary, topic string, partition int, offset bigint, timestamp timestamp, headers array<struct<key:string,value:binary>>")
    rows = from_queue_records(records).collect()
    assert [(r.message_id, r.publish_time, r.attributes) for r in rows] == [
        ("id1", datetime(2024, 1, 1), {"message_id": "id1", "publish_time": "2024-01-01 00:00:00"}), ("t-2-8", NOW, {})]


def test_dedup_and_lateness(spark):
    source, files, progress = (shared_dir(spark, n) for n in ("in", "out", "progress"))
    hour = lambda h: datetime(2024, 1, 10, h)
    arrivals = [[message("k", 1, hour(1)), message("k", 1, hour(1)), message("k", 2, hour(2))],
                [message("k", 2, hour(2)), message("k", 3, hour(8))],
                [message("k", 4, hour(9))],
                [message("k", 5, hour(1)), message("k", 6, hour(9)), message("k", 3, hour(8))]]
    for arrival in arrivals:
        spark.createDataFrame(arrival, MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(source)
        start_window_files(deduplicate(file_messages(spark, source), "2 hours"), files, progress).awaitTermination()
    ids = sorted(r.message_id for r in spark.read.parquet(files).select("message_id").collect())
    assert ids == ["m1", "m2", "m3", "m4", "m6"]  # m5 came after the watermark had passed it


def test_realtime_stream(spark):
    source, progress = shared_dir(spark, "in"), shared_dir(spark, "progress")
    job = realtime_tables(spark)
    docs = cells(spark, {"k1": '{"memberId": "1", "email": "e"}'})
    for i in (1, 2):
        spark.createDataFrame([message("k1", i, NOW)], MESSAGE_SCHEMA).write.mode("append").parquet(source)
        start_realtime(file_messages(spark, source), lambda: docs, MappingRefresh(lambda: mapping(spark)), job, progress,
                       {"availableNow": True}).awaitTermination()
    assert [tuple(r) for r in spark.read.parquet(job.table_path).select("memberId", "email", "batch_id").orderBy(
        "batch_id").collect()] == [("1", "e", 0), ("1", "e", 1)]
