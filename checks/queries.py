"""The registered queries: one per operator or small group of operators."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import views
from goldthread.functions.calendar import PARTITIONS, with_window_path
from goldthread.functions.extract import extract_paths, with_json_value
from goldthread.functions.paths import last_segment, split_path_column
from goldthread.functions.text import utf8_text, variant_kind
from goldthread.operators import cells as wide
from goldthread.operators.changes import apply_changes, change_records
from goldthread.operators.keyed import cogroup_counts, cogroup_rows, drop_null_keys
from goldthread.operators.latest import latest_per_key, newest
from goldthread.operators.mapping import (
    compile_mapping, latest_per_column, latest_snapshot, map_by_column, map_by_segment, map_records, map_shapes)
from goldthread.operators.normalize import (
    Formats, fill_columns, ignore_unknown, normalize_to_schema, parse_json_fields, serialize_nested)
from goldthread.operators.reconcile import reconcile
from goldthread.operators.routing import attempt, split_routes
from goldthread.operators.sizing import BROADCAST_ROWS, semi_join
from goldthread.plans.batch import BatchJob, backfill, in_period, incremental, run_since_mark, write_run
from goldthread.session import shared_dir
from goldthread.sources import readers, sinks, state
from goldthread.streaming.messages import deduplicate, event_keys, file_messages
from goldthread.streaming.realtime import RealtimeJob, start_realtime
from goldthread.streaming.refresh import MappingRefresh
from goldthread.streaming.sinks import start_window_files

CUTOFF = "2024-01-20 00:00:00"
RUN_TIME = datetime(2024, 1, 31, 18, 30)
MEMBER_COLUMNS = ["member_number", "name", "segment", "tier", "updated_date", "o_orderkey"]


def _text(column: str):
    return F.col(column).cast("string").alias(column)


# --- newest rows -----------------------------------------------------------------------------

def latest_persona_per_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = with_json_value(views.personas(spark, sf_dir), "member_id", F.col("profiles"), ["memberId"])
    return latest_per_key(keyed, ["member_id"], newest("timestamp", "event_id")).select(
        "member_id", "personaId", "status", _text("timestamp"))


def latest_member_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(
        views.all_members(spark, sf_dir), ["member_number"], newest("updated_date", "o_orderkey")).select(
        "member_number", "name", "segment", "tier", _text("updated_date"), "o_orderkey")


def latest_mapping_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_snapshot(views.mapping_history(spark, sf_dir)).select(
        "event_id", "dest", "path", "updated_date")


def latest_mapping_per_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_column(views.mapping_history(spark, sf_dir)).select("dest", "path", "updated_date")


def normalize_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.mapping_history(spark, sf_dir).select(
        "event_id", F.array_join(split_path_column(F.col("path")), "/").alias("steps"),
        F.size(split_path_column(F.col("path"))).cast("bigint").alias("n_steps"),
        last_segment(F.concat(F.lit("profiles."), F.col("table_name"))).alias("last_step"))


# --- members of a period ---------------------------------------------------------------------

def members_seen_in_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = views.personas(spark, sf_dir).filter(
        in_period("timestamp", views.newest_event(spark, sf_dir), "2 hours"))
    seen = with_json_value(recent, "member_number", F.col("profiles"), ["memberId"]).select("member_number").distinct()
    newest_rows = latest_per_key(
        views.all_members(spark, sf_dir), ["member_number"], newest("updated_date", "o_orderkey"))
    return semi_join(newest_rows, seen, "member_number").select("member_number", "name", "o_orderkey")


def members_before_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    personas = views.personas(spark, sf_dir).filter(F.col("timestamp") <= F.lit(CUTOFF).cast("timestamp"))
    seen = (with_json_value(personas, "member_number", F.col("profiles"), ["memberId"])
            .filter(F.coalesce("member_number", F.lit("")) != "").select("member_number").distinct())
    newest_rows = latest_per_key(
        views.all_members(spark, sf_dir), ["member_number"], newest("updated_date", "o_orderkey"))
    return semi_join(newest_rows, seen, "member_number").select("member_number", "name", "o_orderkey")


def distinct_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.all_members(spark, sf_dir).select("member_number", "name", "segment", "tier").distinct()


# --- documents -------------------------------------------------------------------------------

def extract_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_paths(
        views.personas(spark, sf_dir),
        {"member_id": ["profiles", "memberId"], "score": ["profiles", "score"], "k": ["profiles", "props", "k"],
         "below_text": ["profiles", "tier", "x"], "missing": ["profiles", "nothing"], "no_column": ["other", "a"]},
        keep=["event_id"])


def extract_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_paths(
        views.personas(spark, sf_dir),
        {"tier": ["profiles", "tier"], "props": ["profiles", "props"], "k": ["profiles", "props", "k"]},
        keep=["event_id"], parse_embedded=False)


def parse_json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = views.personas(spark, sf_dir).withColumn(
        "profiles", F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("{"), "profiles")).otherwise(F.col("profiles")))
    parsed = parse_json_fields(broken)
    valid = variant_kind(F.col("profiles")).startswith("OBJECT")
    return parsed.groupBy("status").agg(
        F.count_if(valid).alias("n_valid"), F.count_if(~valid).alias("n_invalid"),
        F.count(F.try_variant_get("profiles", "$.tier", "string")).alias("n_tier"))


def json_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scalars of a document whose one member is an object."""
    nested = views.personas(spark, sf_dir).withColumn(
        "doc", F.concat(F.lit('{"inner":'), "profiles", F.lit(',"tier":"'), "status", F.lit('"}')))
    scalar = with_json_value(nested, "tier", F.col("doc"), ["tier"])
    scalar = with_json_value(scalar, "inner", F.col("doc"), ["inner"])
    return with_json_value(scalar, "score", F.col("doc"), ["inner", "score"]).select(
        "event_id", "tier", "inner", "score")


def map_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_records(views.personas(spark, sf_dir), views.mapping_rows(spark), "reconcile", keep=["event_id"])


def map_original(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_records(views.personas(spark, sf_dir), views.mapping_rows(spark), "original", keep=["event_id"])


def two_target_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    shapes = map_shapes(views.personas(spark, sf_dir), compile_mapping(views.plain_mapping(spark)), "ms_member", keep=["event_id"])
    pairs = [F.struct(F.lit(name).alias("shape"), F.lit(key).alias("key"), F.col(source).alias("value"))
             for name, columns in (("segment", shapes.segments), ("column", shapes.columns)) for key, source in columns.items()]
    return shapes.flat.select("event_id", F.explode(F.array(*pairs)).alias("x")).select("event_id", "x.*")


def segment_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One shape alone, by its own operator."""
    return map_by_segment(views.personas(spark, sf_dir), compile_mapping(views.plain_mapping(spark)), "ms_member",
                          keep=["event_id"])


def fill_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = compile_mapping(views.plain_mapping(spark))
    mapped = map_by_column(views.personas(spark, sf_dir), rows, "ms_member", keep=["event_id"])
    return fill_columns(mapped, [r.dest for r in rows], keep=["event_id"])


def ignore_unknown_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ignore_unknown(views.all_members(spark, sf_dir), ["o_orderkey", "tier", "not_there", "name"])


def serialize_nested_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = views.table(spark, sf_dir, "events").select(
        "event_id", F.struct("event_type", "user_id").alias("who"), F.create_map(F.lit("id"), "event_id").alias("tags"),
        "event_type")
    return serialize_nested(nested)


def change_record_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = views.table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    at = F.col("ts").cast("timestamp")
    return serialize_nested(
        change_records(source, "UPSERT", at).select(
            F.col("record.event_id").alias("event_id"), F.col("record").dropFields("ts").alias("record"),
            "row_mutation_info"))


# --- keys, groups, reconcile -----------------------------------------------------------------

def _mapped_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_records(
        views.personas(spark, sf_dir), views.mapping_rows(spark), "reconcile", keep=["event_id", "timestamp"],
        filtered=["member_number"])


def drop_null_key_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_null_keys(_mapped_new(spark, sf_dir), "member_number")
    return kept.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("member_number") == "").alias("n_blank"))


def cogroup_count_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cogroup_counts(
        {"new": _mapped_new(spark, sf_dir), "old": views.members(spark, sf_dir)}, "member_number")


def cogroup_all_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = cogroup_rows({"new": _mapped_new(spark, sf_dir), "old": views.members(spark, sf_dir)}, "member_number")
    return grouped.select("member_number", "alias", F.coalesce("new.event_id", "old.o_orderkey").alias("row_id"))


def reconcile_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = latest_per_key(_mapped_new(spark, sf_dir), ["member_number"], newest("timestamp", "event_id"))
    old = latest_per_key(views.members(spark, sf_dir), ["member_number"], newest("updated_date", "o_orderkey"))
    return reconcile(new.drop("event_id", "timestamp"), old, views.mapping_rows(spark), "member_number")


def reconcile_mixed_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapped by the retrieved flag, chosen by the confirmed one, from sides with several rows per key."""
    return reconcile(
        _mapped_new(spark, sf_dir), views.members(spark, sf_dir), views.mapping_rows(spark), "member_number", "original",
        new_order=("timestamp", "event_id"), old_order=("updated_date", "o_orderkey"))


# --- normalise -------------------------------------------------------------------------------

def _normalized(df: DataFrame, key: list[str], name: str, dtype: T.DataType, formats: Formats = Formats()) -> DataFrame:
    schema = T.StructType([*[df.schema[k] for k in key], T.StructField(name, dtype)])
    return normalize_to_schema(df, schema, formats).select(*key, _text(name))


def normalize_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = views.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS priority",
        "o_custkey", "round(o_totalprice * 1000, 1) AS price", "o_orderkey % 2 = 0 AS even")
    schema = T.StructType([source.schema["o_orderkey"]] + [
        T.StructField(n, T.StringType()) for n in ("priority", "o_custkey", "price", "even", "absent")])
    return normalize_to_schema(source, schema)


def normalize_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = views.table(spark, sf_dir, "orders").selectExpr("o_orderkey", """
        CASE o_orderkey % 8
          WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd') WHEN 1 THEN date_format(o_orderdate, 'd/M/yyyy')
          WHEN 2 THEN date_format(o_orderdate, 'yyyy/MM/dd') WHEN 3 THEN concat('  ', date_format(o_orderdate, 'yyyy-M-d'), ' ')
          WHEN 4 THEN date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') WHEN 5 THEN '2023-02-30' WHEN 6 THEN '' END AS d""")
    return _normalized(source, ["o_orderkey"], "d", T.DateType())


def normalize_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = views.table(spark, sf_dir, "events").selectExpr("event_id", """
        CASE event_id % 8
          WHEN 0 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS') WHEN 1 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss')
          WHEN 2 THEN concat(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), 'Z')
          WHEN 3 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss") WHEN 4 THEN concat(' ', date_format(ts, 'yyyy-M-d H:m:s'), '  ')
          WHEN 5 THEN date_format(ts, 'yyyy-MM-dd') WHEN 6 THEN 'soon' END AS t""")
    return _normalized(source, ["event_id"], "t", T.TimestampNTZType())


def normalize_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = views.table(spark, sf_dir, "events").selectExpr("event_id", """
        CASE event_id % 5
          WHEN 0 THEN CAST(unix_seconds(CAST(ts AS TIMESTAMP)) AS STRING)
          WHEN 1 THEN CAST(unix_millis(CAST(ts AS TIMESTAMP)) AS STRING)
          WHEN 2 THEN concat(CAST(unix_seconds(CAST(ts AS TIMESTAMP)) AS STRING), 'Z')
          WHEN 3 THEN concat(CAST(unix_seconds(CAST(ts AS TIMESTAMP)) AS STRING), '.5')
          ELSE concat('-', CAST(event_id AS STRING)) END AS t""")
    return _normalized(source, ["event_id"], "t", T.TimestampNTZType())


def normalize_bools(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = views.table(spark, sf_dir, "events").selectExpr("event_id", """
        CASE event_id % 9 WHEN 0 THEN 'TRUE' WHEN 1 THEN '1' WHEN 2 THEN 'Yes' WHEN 3 THEN 'no' WHEN 4 THEN ''
          WHEN 5 THEN ' true' WHEN 6 THEN event_type WHEN 7 THEN 'false' END AS b""")
    return _normalized(source, ["event_id"], "b", T.BooleanType())


def normalize_ints(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = views.table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", """
        CASE l_orderkey % 7 WHEN 0 THEN CAST(l_partkey AS STRING) WHEN 1 THEN concat(' +', l_partkey, ' ')
          WHEN 2 THEN CAST(l_extendedprice AS STRING) WHEN 3 THEN concat('-', l_partkey) WHEN 4 THEN ''
          WHEN 5 THEN l_returnflag ELSE concat(l_partkey, '99999999999999999999') END AS i""",
        "l_extendedprice AS from_double")
    schema = T.StructType([source.schema["l_orderkey"], source.schema["l_linenumber"],
                           T.StructField("i", T.LongType()), T.StructField("from_double", T.LongType())])
    return normalize_to_schema(source, schema).groupBy("l_orderkey").agg(
        F.count("i").alias("n_whole"), F.sum("i").cast("string").alias("sum_whole"),
        F.sum("from_double").alias("sum_truncated"))


def normalize_doubles(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = views.table(spark, sf_dir, "orders").selectExpr("o_orderkey", """
        CASE o_orderkey % 7 WHEN 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING)
          WHEN 1 THEN concat(' ', CAST(o_custkey AS STRING), 'e2 ') WHEN 2 THEN concat(CAST(o_custkey AS STRING), 'd')
          WHEN 3 THEN '' WHEN 4 THEN o_orderstatus WHEN 5 THEN concat('.', CAST(o_custkey AS STRING)) ELSE '0x1p3' END AS x""")
    schema = T.StructType([source.schema["o_orderkey"], T.StructField("x", T.DoubleType())])
    return normalize_to_schema(source, schema).select(
        "o_orderkey", F.col("x").cast("decimal(24,6)").cast("string").alias("x"))


def normalize_decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = views.table(spark, sf_dir, "orders").selectExpr("o_orderkey", """
        CASE o_orderkey % 4 WHEN 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING)
          WHEN 1 THEN concat(CAST(o_custkey AS STRING), '.123456789') WHEN 2 THEN o_orderstatus ELSE '' END AS x""")
    return _normalized(source, ["o_orderkey"], "x", T.DecimalType(38, 9))


# --- windows and folders ---------------------------------------------------------------------

def window_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    framed = with_window_path(views.messages(spark, sf_dir), "publish_time", "5 minutes")
    return framed.groupBy("_window_path", "_window_timestamp").agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.col("_window_path").alias("window_path"), F.col("_window_timestamp").cast("string").alias("window_end"),
        "n_rows")


def rows_per_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    framed = with_window_path(views.messages(spark, sf_dir), "publish_time", "5 minutes")
    return sinks.rows_written(framed.withColumnRenamed("_window_path", "folder"), "folder")


# --- cells -----------------------------------------------------------------------------------

def latest_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide.latest_cells(views.cells(spark, sf_dir)).select(
        *wide.CELL, _text("ts"), F.hex("value").alias("value_hex"))


def decode_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide.row_documents(views.cells(spark, sf_dir), ["profiles", "absent"])


def decode_whole_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Families with the single qualifier ``value``: object, array, text and bad UTF-8."""
    single = views.table(spark, sf_dir, "events").selectExpr(
        "CAST(event_id AS STRING) AS row_key", "'profiles' AS family", "'value' AS qualifier",
        "CAST(ts AS TIMESTAMP) AS ts",
        """CASE event_id % 6 WHEN 0 THEN encode(props, 'UTF-8') WHEN 1 THEN encode(concat('[', props, ']'), 'UTF-8')
             WHEN 2 THEN encode(event_type, 'UTF-8') WHEN 3 THEN unhex('FF00AB')
             WHEN 4 THEN encode(concat('{', props), 'UTF-8') ELSE encode('', 'UTF-8') END AS value""")
    return wide.row_documents(single)


def cells_by_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide.cells_by_ranges(views.cells(spark, sf_dir), [("1", "12"), ("11", "2"), ("95", None)]).select(
        "event_id", "row_key", "qualifier")


def cells_of_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point reads for the customers of one market segment, a key set that grows with the data."""
    keys = views.table(spark, sf_dir, "customer").filter("c_mktsegment = 'MACHINERY'").selectExpr(
        "CAST(c_custkey AS STRING) AS row_key")
    return wide.of_families(
        wide.cells_by_keys(views.cells(spark, sf_dir), keys, BROADCAST_ROWS), ["profiles"]).select(
        "event_id", "row_key", "qualifier")


def flatten_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = wide.flatten_cells(
        views.cells(spark, sf_dir), [("profiles", "click"), ("profiles", "view"), ("other", "click")])
    return flat.select("row_key", F.col("`profiles:click`").alias("profiles_click"),
                       F.col("`profiles:view`").alias("profiles_view"), F.col("`other:click`").alias("other_click"))


def lookup_all_qualifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every qualifier of every row, none named beforehand."""
    return wide.row_maps(views.cells(spark, sf_dir), ["profiles"]).select("row_key", F.explode("cells").alias("qualifier", "value"))


def enrich_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = event_keys(views.messages(spark, sf_dir)).select("message_id", "persona_id")
    found = wide.enrich_by_key(keyed, views.profile_cells(spark, sf_dir), "persona_id")
    member = with_json_value(found, "member_id", F.col("profiles"), ["memberId"], scalar=False)
    return wide.has_text(member, F.col("member_id")).select("message_id", "persona_id", "member_id")


def message_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_keys(views.messages(spark, sf_dir)).groupBy("persona_id").agg(
        F.count(F.lit(1)).alias("n_messages"))


# --- changes and routing ---------------------------------------------------------------------

def upsert_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = views.table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS member_number", "c_mktsegment AS tier")
    changes = views.table(spark, sf_dir, "events").selectExpr(
        "CAST(user_id AS STRING) AS member_number", "event_type AS tier",
        "CASE WHEN event_type = 'error' THEN 'DELETE' ELSE 'UPSERT' END AS _CHANGE_TYPE", "ts", "event_id")
    return apply_changes(current, changes, ["member_number"], ["ts", "event_id"])


def _attempted(messages: DataFrame) -> DataFrame:
    def process(df: DataFrame) -> DataFrame:
        keyed = with_json_value(df, "result", utf8_text(F.col("data")), ["payload", "personaId"])
        return keyed.withColumn("error", F.when(F.col("result").isNull(), "no persona id"))

    return attempt(messages, process)


def route_retry_dlq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _attempted(views.messages(spark, sf_dir)).groupBy("route").agg(F.count(F.lit(1)).alias("n_rows"))


def retry_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return split_routes(_attempted(views.messages(spark, sf_dir)), at).retry.select(
        "message_id", F.col("data").cast("string").alias("data"), "error", "retry_count", _text("timestamp"))


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "dead-letters")
    dead = sinks.dead_letter_lines(split_routes(_attempted(views.odd_messages(spark, sf_dir))).dead)
    sinks.write_lines(dead, path)
    return readers.read_json_lines(
        spark, path, "message_id string, data string, data_encoding string, error string, retry_count bigint, "
                     "final_failure boolean")


# --- round trips -----------------------------------------------------------------------------

def partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "run")
    run = views.all_members(spark, sf_dir).select("member_number", "name", "tier", "o_orderkey")
    write_run(run.filter("o_orderkey % 2 = 0"), path, RUN_TIME)
    write_run(run, path, RUN_TIME)
    schema = ", ".join([run.schema.toDDL(), *[f"{p} string" for p in PARTITIONS]])
    return spark.read.schema(schema).parquet(path)


def sharded_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "shards")
    sinks.write_parquet(views.all_members(spark, sf_dir).select("o_orderkey", "name"), path, shards=5)
    written = spark.read.parquet(path).withColumn("file", F.col("_metadata.file_name"))
    return written.groupBy(F.lit("all").alias("scope")).agg(
        F.countDistinct("file").alias("n_files"), F.count(F.lit(1)).alias("n_rows"),
        F.sum("o_orderkey").alias("sum_key"))


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "json")
    source = views.all_members(spark, sf_dir).select("member_number", "name", "o_orderkey")
    sinks.write_lines(source, path, "json")
    line = readers.read_json_lines(spark, path)
    return line.select(
        F.try_variant_get("value", "$.member_number", "string").alias("member_number"),
        F.try_variant_get("value", "$.name", "string").alias("name"),
        F.try_variant_get("value", "$.o_orderkey", "bigint").alias("o_orderkey"))


def text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "text")
    sinks.write_lines(views.all_members(spark, sf_dir).selectExpr("concat(o_orderkey, ' ', name) AS line"), path)
    return readers.read_text_lines(spark, path).withColumnRenamed("value", "line")


def _fresh_table(spark: SparkSession, label: str) -> str:
    """A table name in a database of its own, whose files lie in the shared folder."""
    path = shared_dir(spark, label)
    database = path.rsplit("/", 1)[-1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{path}'")
    return f"{database}.{label.replace('-', '_')}"


def snapshot_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = shared_dir(spark, "snapshot-source")
    views.all_members(spark, sf_dir).select("member_number", "o_orderkey").write.parquet(source)
    name = _fresh_table(spark, "snapshot")
    sinks.load_snapshot(spark, source, name)
    sinks.load_snapshot(spark, source, name)
    return spark.table(name)


def table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create, append and replace."""
    name = _fresh_table(spark, "appended")
    rows = views.all_members(spark, sf_dir).select("member_number", "o_orderkey")
    sinks.write_table(rows, name)
    sinks.write_table(rows.filter("o_orderkey % 2 = 0"), name, "truncate")
    sinks.write_table(rows.filter("o_orderkey % 2 = 1"), name, create=False)
    return spark.table(name)


def table_append_ignoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An append with a column the table lacks, which is left out by request, and one under a name in other case."""
    name = _fresh_table(spark, "appended")
    rows = views.all_members(spark, sf_dir).select("member_number", "o_orderkey")
    sinks.write_table(rows.filter("o_orderkey % 2 = 0"), name)
    more = rows.filter("o_orderkey % 2 = 1").withColumn("unknown", F.lit(1)).withColumnRenamed("o_orderkey", "O_ORDERKEY")
    sinks.write_table(more, name, ignore_unknown=True)
    return spark.table(name)


def upsert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _fresh_table(spark, "upserted")
    views.table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS member_number", "c_mktsegment AS tier").write.saveAsTable(name)
    changes = views.table(spark, sf_dir, "events").selectExpr(
        "CAST(user_id AS STRING) AS member_number", "event_type AS tier",
        "CASE WHEN event_type = 'error' THEN 'DELETE' ELSE 'UPSERT' END AS _CHANGE_TYPE", "ts", "event_id")
    for rest in (0, 1):
        sinks.upsert_table(changes.filter(F.col("event_id") % 2 == rest), name, ["member_number"], ["ts", "event_id"])
    return spark.table(name)


def upsert_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same changes on a table in folders by key hash, of which only the changed ones are rewritten."""
    path = shared_dir(spark, "buckets")
    sinks.write_buckets(views.table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS member_number", "c_mktsegment AS tier"), path, ["member_number"], 16)
    changes = views.table(spark, sf_dir, "events").selectExpr(
        "CAST(user_id AS STRING) AS member_number", "event_type AS tier",
        "CASE WHEN event_type = 'error' THEN 'DELETE' ELSE 'UPSERT' END AS _CHANGE_TYPE", "ts", "event_id")
    for rest in (0, 1):
        sinks.upsert_buckets(
            changes.filter(F.col("event_id") % 2 == rest), path, ["member_number"], ["ts", "event_id"], 16)
    return sinks.read_buckets(spark, path)


def high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "mark")
    events = views.table(spark, sf_dir, "events")
    everything = state.newer_than_mark(events, "ts", state.read_mark(spark, path))
    state.save_mark(everything.filter(F.col("ts") <= F.lit(CUTOFF).cast("timestamp_ntz")), "ts", path)
    return state.newer_than_mark(events, "ts", state.read_mark(spark, path)).select("event_id", _text("ts"))


def query_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    query = """
        SELECT * EXCEPT (rn) FROM (
          SELECT user_id, event_id, event_type,
                 ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
          FROM IDENTIFIER(:source) WHERE ts <= CAST(:cutoff AS TIMESTAMP_NTZ)) WHERE rn = 1"""
    return readers.read_query(
        spark, query, {"source": "query_source_events", "cutoff": CUTOFF},
        {"query_source_events": views.table(spark, sf_dir, "events")})


def record_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the member of the newest event occurs: a count with a bound parameter."""
    events = views.table(spark, sf_dir, "events")
    member = events.agg(F.max_by("user_id", F.struct("ts", "event_id"))).scalar()
    return events.filter(F.col("user_id") == member).agg(F.count(F.lit(1)).alias("n_rows"))


# --- jobs ------------------------------------------------------------------------------------

def batch_job() -> BatchJob:
    return BatchJob(
        T.StructType([
            T.StructField("member_number", T.StringType()), T.StructField("name", T.StringType()),
            T.StructField("segment", T.StringType()), T.StructField("tier", T.StringType()),
            T.StructField("k", T.LongType()), T.StructField("joined", T.DateType())]),
        persona_order=("timestamp", "event_id"), member_order=("updated_date", "o_orderkey"))


def reconcile_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backfill(
        views.personas(spark, sf_dir), views.members(spark, sf_dir), views.mapping(spark), batch_job(),
        F.lit(CUTOFF).cast("timestamp")).withColumn("joined", F.col("joined").cast("string"))


def reconcile_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental(
        views.personas(spark, sf_dir), views.members(spark, sf_dir), views.mapping(spark), batch_job(),
        views.newest_event(spark, sf_dir), "2 hours").withColumn("joined", F.col("joined").cast("string"))


def reconcile_since_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs from one high-water mark: all events up to the cut-off, then what has come since; the rows of the second."""
    mark, path = shared_dir(spark, "mark"), shared_dir(spark, "marked-runs")
    personas, members, mapping = views.personas(spark, sf_dir), views.members(spark, sf_dir), views.mapping(spark)
    early = personas.filter(F.col("timestamp") <= F.lit(CUTOFF).cast("timestamp"))
    for rows, run_time in ((early, RUN_TIME), (personas, RUN_TIME + timedelta(hours=1)), (personas, RUN_TIME + timedelta(hours=2))):
        run_since_mark(rows, members, mapping, batch_job(), mark, path, run_time, shards=4)
    # The third run found nothing new and wrote no folder.
    second = spark.read.parquet(path).filter(F.col("run_dt") != "2024020101")
    return second.select(*batch_job().schema.names).withColumn("joined", F.col("joined").cast("string"))


def reconcile_with_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The backfill with a caller's own frame-to-frame step."""
    base = batch_job()
    job = BatchJob(base.schema, persona_order=base.persona_order, member_order=base.member_order,
                   steps=[lambda df: df.withColumn("k", F.try_variant_get("k", "$", "bigint") + 1000)])
    return backfill(
        views.personas(spark, sf_dir), views.members(spark, sf_dir), views.mapping(spark), job,
        F.lit(CUTOFF).cast("timestamp")).select("member_number", "k")


def reconcile_backfill_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The backfill with a column of every type, written in shards under its run folder and read back."""
    kinds = {"member_number": "string", "joined": "date", "seen": "timestamp", "active": "boolean", "score": "double",
             "amount": "decimal(12,2)", "visits": "bigint"}
    job = BatchJob(T.StructType.fromDDL(", ".join(f"{c} {k}" for c, k in kinds.items())),
                   persona_order=("timestamp", "event_id"), member_order=("updated_date", "o_orderkey"))
    path = shared_dir(spark, "typed-run")
    write_run(backfill(views.typed_personas(spark, sf_dir), views.all_members(spark, sf_dir), views.typed_mapping(spark), job,
                       F.lit(CUTOFF).cast("timestamp")), path, RUN_TIME, shards=3)
    written = spark.read.schema(", ".join([*(f"{c} {k}" for c, k in kinds.items()), "run_dt string"])).parquet(path)
    return written.select(*[_text(c) if k in ("date", "timestamp", "decimal(12,2)") else c for c, k in kinds.items()], "run_dt")


# --- streams ---------------------------------------------------------------------------------

def stream_dedup_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message stream with repeats and late rows, deduplicated and written by window.

    Arrivals: the events of days 6 to 20, the later events, the later events again, and at last the
    first five days, which the watermark has long passed.
    """
    source, files, checkpoint = (shared_dir(spark, n) for n in ("arrivals", "windows", "progress"))
    messages = views.messages(spark, sf_dir)
    day = F.dayofmonth("publish_time")
    later = messages.filter(day > 20)
    for slice_ in (messages.filter(day.between(6, 20)), later, later, messages.filter(day < 6)):
        slice_.write.mode("append").parquet(source)
        start_window_files(deduplicate(file_messages(spark, source), "1 day"), files, checkpoint,
                           state_partitions=spark.sparkContext.defaultParallelism).awaitTermination()
    written = spark.read.schema(
        "message_id string, publish_time timestamp, par_month string, par_day string, par_hour string, run_dt string"
    ).parquet(files)
    return written.groupBy(*PARTITIONS).agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("message_id").alias("n_messages"))


def realtime_job(table_path: str, files_path: str, dead_letter_path: str) -> RealtimeJob:
    return RealtimeJob(
        table_path, files_path, "ms_member", dead_letter_path, table_columns=("memberId", "tier", "fullName"))


def stream_realtime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The realtime job over two arrivals, the first and the second half of the month.

    In between the mapping gets another path for tier.
    """
    source, checkpoint, table_path, files_path, dead_path = (
        shared_dir(spark, n) for n in ("arrivals", "progress", "rows", "windows", "dead"))
    first = views.mapping(spark).filter("updated_date IS NOT NULL").withColumn("path", F.expr(
        "CASE WHEN dest = 'tier' THEN 'profiles.tier' ELSE path END"))
    second = first.withColumn("path", F.expr("CASE WHEN dest = 'tier' THEN 'profiles.score' ELSE path END"))
    newest_mapping = {0: first, 1: second}
    arrival = 0
    refresh = MappingRefresh(lambda: newest_mapping[arrival], interval=0.0)
    job = realtime_job(table_path, files_path, dead_path)
    messages = views.messages(spark, sf_dir)
    for arrival in (0, 1):
        messages.filter((F.dayofmonth("publish_time") > 15) == bool(arrival)).write.mode("append").parquet(source)
        start_realtime(file_messages(spark, source), lambda: views.profile_cells(spark, sf_dir), refresh, job,
                       checkpoint, {"availableNow": True}).awaitTermination()
    rows = spark.read.parquet(table_path)
    windows = spark.read.schema(
        "member_number string, tier string, name string, segment string, k string, run_dt string").parquet(files_path)
    dead = spark.read.parquet(dead_path)
    counted = [
        rows.select(F.lit("rows").alias("sink"), F.col("memberId").alias("member"), "tier"),
        windows.select(F.lit("windows").alias("sink"), F.col("member_number").alias("member"), "tier"),
        dead.select(F.lit("dead").alias("sink"), F.lit(None).cast("string").alias("member"),
                    F.get_json_object("value", "$.error_type").alias("tier"))]
    return counted[0].unionByName(counted[1]).unionByName(counted[2]).groupBy("sink", "member", "tier").agg(
        F.count(F.lit(1)).alias("n_rows"))


def stream_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message in exactly one outcome: a row, a dead letter by its reason, or no document."""
    source, checkpoint, table_path, files_path, dead_path = (
        shared_dir(spark, n) for n in ("arrivals", "progress", "rows", "windows", "dead"))
    messages = views.odd_messages(spark, sf_dir)
    messages.write.parquet(source)
    start_realtime(
        file_messages(spark, source), lambda: views.profile_cells(spark, sf_dir),
        MappingRefresh(lambda: views.plain_mapping(spark)), realtime_job(table_path, files_path, dead_path), checkpoint,
        {"availableNow": True}).awaitTermination()
    one = F.lit(1)
    rows = spark.read.parquet(table_path).select(F.lit("row").alias("outcome"), F.lit(None).cast("string").alias("data_encoding"), one.alias("n"))
    dead = spark.read.parquet(dead_path).select(
        F.get_json_object("value", "$.error").alias("outcome"),
        F.get_json_object("value", "$.data_encoding").alias("data_encoding"), one.alias("n"))
    settled = rows.unionByName(dead)
    rest = messages.agg(F.count(one).alias("all")).crossJoin(settled.agg(F.count(one).alias("some"))).select(
        F.lit("no document").alias("outcome"), F.lit(None).cast("string").alias("data_encoding"),
        (F.col("all") - F.col("some")).cast("int").alias("n"))
    return settled.unionByName(rest).groupBy("outcome", "data_encoding").agg(F.sum("n").alias("n_messages"))
