"""Inputs of the registered queries, all derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldthread.operators.mapping import MappingRow, compile_mapping, latest_snapshot


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Wall-clock columns of the tables become instants by the session's zone, and are compared with engines without one.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def personas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One in ten has no memberId, one in ten a blank one; props is a JSON string inside JSON."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", "concat('p', event_id) AS personaId",
        """CASE WHEN event_id % 10 = 0
             THEN to_json(named_struct('tier', event_type, 'score', value, 'props', props))
             ELSE to_json(named_struct(
               'memberId', CASE WHEN event_id % 10 = 5 THEN '' ELSE CAST(user_id AS STRING) END,
               'tier', event_type, 'score', value, 'props', props)) END AS profiles""",
        "event_type AS status", "CAST(ts AS TIMESTAMP) AS timestamp", "user_id")


def typed_personas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a value for every type of column."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        """to_json(named_struct(
             'memberId', CASE WHEN event_id % 10 = 5 THEN '' ELSE CAST(user_id AS STRING) END,
             'joined', date_format(ts, 'yyyy-MM-dd'), 'seen', date_format(ts, 'yyyy-MM-dd HH:mm:ss'),
             'active', event_id % 2 = 0, 'score', value, 'amount', concat(event_id, '.25'), 'visits', event_id % 7)) AS profiles""",
        "CAST(ts AS TIMESTAMP) AS timestamp")


def typed_mapping(spark: SparkSession) -> DataFrame:
    return spark.sql("""
        SELECT dest, concat('profiles.', step) AS path, true AS retrieved, true AS confirmed, '2024-02-01' AS updated_date,
               'ms_member' AS table_name
        FROM VALUES ('member_number', 'memberId'), ('joined', 'joined'), ('seen', 'seen'), ('active', 'active'),
                    ('score', 'score'), ('amount', 'amount'), ('visits', 'visits') AS mapping(dest, step)""")


def plain_mapping(spark: SparkSession) -> DataFrame:
    """Plain dotted paths, one of which no document has, and a column without a path."""
    return spark.sql("""
        SELECT dest, path, true AS retrieved, true AS confirmed, '2024-02-01' AS updated_date, 'ms_member' AS table_name
        FROM VALUES ('member_number', 'profiles.memberId'), ('tier', 'profiles.tier'), ('rating', 'profiles.score'),
                    ('details', 'profiles.props'), ('missing', 'profiles.nothing'), ('unmapped', '') AS mapping(dest, path)""")


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several rows per key; every third customer is missing, so that some personas are of new members."""
    return all_members(spark, sf_dir).filter("try_cast(member_number AS BIGINT) % 3 <> 0")


def all_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several rows per key, one for each order."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return (orders.join(customer, orders.o_custkey == customer.c_custkey)
            .selectExpr("CAST(o_custkey AS STRING) AS member_number", "c_name AS name",
                        "c_mktsegment AS segment", "o_orderstatus AS tier",
                        "CAST(o_orderdate AS TIMESTAMP) AS updated_date", "o_orderkey"))


def mapping(spark: SparkSession) -> DataFrame:
    return spark.sql("""
        SELECT * FROM VALUES
         ('member_number', 'profiles.memberId',      true,  true,  '2024-02-01', 'ms_member'),
         ('tier',          'profiles[''tier'']',     true,  false, '2024-02-01', 'ms_member'),
         ('name',          'profiles.fullName',      true,  false, '2024-02-01', 'ms_member'),
         ('segment',       'profiles.segment',       false, true,  '2024-02-01', 'ms_member'),
         ('k',             'profiles.props.k',       true,  false, '2024-02-01', 'ms_member'),
         ('unmapped',      '',                       true,  true,  '2024-02-01', 'ms_member'),
         ('tier',          'profiles.oldTier',       true,  true,  '2024-01-01', 'ms_member'),
         ('score',         'profiles.score',         true,  true,  CAST(NULL AS STRING), 'other')
        AS mapping(dest, path, retrieved, confirmed, updated_date, table_name)""")


def mapping_rows(spark: SparkSession) -> list[MappingRow]:
    return compile_mapping(latest_snapshot(mapping(spark)))


def mapping_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mapping table with many versions: one row per event, a destination per user.

    Paths come in all spellings; one event in nine is undated.
    """
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", "concat('col_', user_id) AS dest",
        """CASE event_id % 6
             WHEN 0 THEN concat('profiles.', event_type, '.v', event_id)
             WHEN 1 THEN concat('profiles[''', event_type, '''].v', event_id)
             WHEN 2 THEN concat('[''profiles''][''', event_type, '''][''v', event_id, ''']')
             WHEN 3 THEN concat('profiles["', event_type, '"]["v', event_id, '"]')
             WHEN 4 THEN concat(' profiles[', event_type, '] . v', event_id, ' ')
             ELSE '' END AS path""",
        "event_id % 2 = 0 AS retrieved", "event_id % 3 = 0 AS confirmed",
        "CASE WHEN event_id % 9 <> 0 THEN date_format(ts, 'yyyy-MM-dd') END AS updated_date",
        "event_type AS table_name")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON, plain text and invalid UTF-8 values, many versions per qualifier."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", "CAST(user_id AS STRING) AS row_key", "'profiles' AS family", "event_type AS qualifier",
        "CAST(ts AS TIMESTAMP) AS ts",
        """CASE WHEN event_id % 11 = 0 THEN unhex('FF00')
                WHEN event_id % 3 = 0 THEN encode(props, 'UTF-8') ELSE encode(event_type, 'UTF-8') END AS value""")


def profile_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-document cells: the persona documents as versions of one qualifier per user."""
    return personas(spark, sf_dir).selectExpr(
        "CAST(user_id AS STRING) AS row_key", "'profiles' AS family", "'value' AS qualifier",
        "timestamp AS ts", "encode(profiles, 'UTF-8') AS value")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One in 13 is broken JSON, one in 13 has no payload."""
    return table(spark, sf_dir, "events").selectExpr(
        "CAST(event_id AS STRING) AS message_id", "CAST(ts AS TIMESTAMP) AS publish_time",
        """encode(CASE event_id % 13 WHEN 0 THEN '{bad' WHEN 1 THEN '{}'
             ELSE to_json(named_struct('type', 'UPSERT', 'payload',
                                       named_struct('personaId', CAST(user_id AS STRING)))) END, 'UTF-8') AS data""",
        "map('retry_count', CAST(event_id % 5 AS STRING)) AS attributes")


def odd_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages, of which one in 17 has a blank key and one in 19 bytes that are not UTF-8."""
    return messages(spark, sf_dir).withColumn("data", F.expr("""
        CASE WHEN CAST(message_id AS BIGINT) % 19 = 3 THEN unhex('FFFE7B')
             WHEN CAST(message_id AS BIGINT) % 17 = 2 THEN encode('{"payload":{"personaId":""}}', 'UTF-8') ELSE data END"""))


def newest_event(spark: SparkSession, sf_dir: str):
    """The reference time of clock-dependent queries: the newest event, as a scalar subquery."""
    return table(spark, sf_dir, "events").agg(F.max(F.col("ts").cast("timestamp"))).scalar()
