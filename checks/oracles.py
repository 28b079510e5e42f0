"""The same results in SQL on the given tables, for another engine."""

from __future__ import annotations

# The member id of an event's document, null for one in ten.
MEMBER = "CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 10 = 5 THEN '' ELSE CAST(user_id AS VARCHAR) END"
VALUE = "CAST(value AS VARCHAR)"
K = "json_extract_string(props, '$.k')"
CUTOFF = "TIMESTAMP '2024-01-20 00:00:00'"

ALL_MEMBERS = """
  SELECT CAST(o_custkey AS VARCHAR) AS member_number, c_name AS name, c_mktsegment AS segment,
         o_orderstatus AS tier, o_orderdate AS updated_date, o_orderkey
  FROM orders JOIN customer ON o_custkey = c_custkey"""

# Every third customer is missing, so that some personas are of new members.
MEMBERS = f"SELECT * FROM ({ALL_MEMBERS}) WHERE CAST(member_number AS BIGINT) % 3 <> 0"

LATEST_MEMBERS = f"""
  SELECT * FROM ({MEMBERS})
  QUALIFY row_number() OVER (PARTITION BY member_number ORDER BY updated_date DESC, o_orderkey DESC) = 1"""

LATEST_OF_ALL = LATEST_MEMBERS.replace(MEMBERS, ALL_MEMBERS)

MAPPING = """
  SELECT event_id, 'col_' || user_id AS dest, event_type,
         CASE event_id % 6
           WHEN 0 THEN 'profiles.' || event_type || '.v' || event_id
           WHEN 1 THEN 'profiles[''' || event_type || '''].v' || event_id
           WHEN 2 THEN '[''profiles''][''' || event_type || '''][''v' || event_id || ''']'
           WHEN 3 THEN 'profiles["' || event_type || '"]["v' || event_id || '"]'
           WHEN 4 THEN ' profiles[' || event_type || '] . v' || event_id || ' '
           ELSE '' END AS path,
         CASE WHEN event_id % 9 <> 0 THEN strftime(ts, '%Y-%m-%d') END AS updated_date
  FROM events"""

CELLS = r"""
  SELECT event_id, CAST(user_id AS VARCHAR) AS row_key, 'profiles' AS family, event_type AS qualifier, ts,
         CASE WHEN event_id % 11 = 0 THEN '\xFF\x00'::BLOB
              WHEN event_id % 3 = 0 THEN encode(props) ELSE encode(event_type) END AS value,
         CASE WHEN event_id % 11 = 0 THEN 'ff00' WHEN event_id % 3 = 0 THEN props ELSE event_type END AS txt,
         CASE WHEN event_id % 11 = 0 THEN '"ff00"' WHEN event_id % 3 = 0 THEN props
              ELSE '"' || event_type || '"' END AS js
  FROM events"""

LATEST_CELLS = f"""
  SELECT * FROM ({CELLS})
  QUALIFY row_number() OVER (PARTITION BY row_key, family, qualifier ORDER BY ts DESC, value DESC) = 1"""

# The newest document of every user.
LATEST_DOCUMENTS = f"""
  SELECT user_id, event_type, value, {MEMBER} AS member_id FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1"""

FOUND = f"""
  SELECT e.event_id, e.ts, e.user_id, d.event_type, d.value, d.member_id
  FROM events e JOIN ({LATEST_DOCUMENTS}) d USING (user_id)
  WHERE e.event_id % 13 NOT IN (0, 1) AND d.member_id <> ''"""

WINDOW_END = "time_bucket(INTERVAL 5 MINUTES, ts) + INTERVAL 5 MINUTES + INTERVAL 7 HOURS"
FOLDER = f"strftime({WINDOW_END}, 'par_month=%m/par_day=%d/par_hour=%H/run_dt=%Y%m%d%H')"

MAPPED = f"""
  SELECT event_id, ts, {MEMBER} AS member_number, event_type AS tier, {K} AS k FROM events"""

LATEST_MAPPED = f"""
  SELECT * FROM ({MAPPED}) WHERE member_number IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY member_number ORDER BY ts DESC, event_id DESC) = 1"""

CHANGES = """
  SELECT CAST(c_custkey AS VARCHAR) AS member_number, c_mktsegment AS tier, 'UPSERT' AS change,
         NULL::TIMESTAMP AS ts, -1 AS event_id, -1 AS pass FROM customer
  UNION ALL
  SELECT CAST(user_id AS VARCHAR), event_type, CASE WHEN event_type = 'error' THEN 'DELETE' ELSE 'UPSERT' END,
         ts, event_id, event_id % 2 FROM events"""

ROUTED = """
  SELECT event_id, event_id % 5 AS tries, CASE event_id % 13 WHEN 0 THEN '{bad' WHEN 1 THEN '{}' END AS data,
         CASE WHEN event_id % 13 NOT IN (0, 1) THEN 'success' WHEN event_id % 5 < 3 THEN 'retry' ELSE 'dlq' END AS route
  FROM events"""


def _seen(condition: str) -> str:
    return f"""
      SELECT member_number, name, o_orderkey FROM ({LATEST_OF_ALL})
      WHERE member_number IN (SELECT {MEMBER} FROM events WHERE {condition})"""


def _reconciled(condition: str, k: str = "CAST(n.k AS BIGINT)") -> str:
    return f"""
      SELECT n.member_number, '' AS name, coalesce(o.segment, '') AS segment, n.tier, {k} AS k,
             NULL::VARCHAR AS joined
      FROM (SELECT * FROM ({MAPPED}) WHERE {condition}
            QUALIFY row_number() OVER (PARTITION BY member_number ORDER BY ts DESC, event_id DESC) = 1) n
      LEFT JOIN ({LATEST_MEMBERS}) o USING (member_number)"""


PERIOD = "ts BETWEEN (SELECT max(ts) FROM events) - INTERVAL 2 HOURS AND (SELECT max(ts) FROM events)"

ORACLES: dict[str, str] = {
    "latest_persona_per_member": f"""
        SELECT {MEMBER} AS member_id, 'p' || event_id AS "personaId", event_type AS status,
               CAST(ts AS VARCHAR) AS timestamp
        FROM events
        QUALIFY row_number() OVER (PARTITION BY {MEMBER} ORDER BY ts DESC, event_id DESC) = 1""",
    "latest_member_row": f"""
        SELECT member_number, name, segment, tier, CAST(updated_date AS VARCHAR) AS updated_date, o_orderkey
        FROM ({LATEST_OF_ALL})""",
    "latest_mapping_snapshot": f"""
        SELECT event_id, dest, path, updated_date FROM ({MAPPING})
        WHERE coalesce(updated_date, '1999-12-31') =
              (SELECT coalesce(max(updated_date), '1999-12-31') FROM ({MAPPING}))""",
    "latest_mapping_per_column": f"""
        SELECT dest, path, updated_date FROM ({MAPPING})
        QUALIFY row_number() OVER (
          PARTITION BY dest ORDER BY updated_date DESC NULLS LAST, path DESC NULLS LAST) = 1""",
    "normalize_paths": """
        SELECT event_id, CASE WHEN event_id % 6 < 5 THEN 'profiles/' || event_type || '/v' || event_id ELSE '' END AS steps,
               CAST(CASE WHEN event_id % 6 < 5 THEN 3 ELSE 0 END AS BIGINT) AS n_steps, event_type AS last_step
        FROM events""",
    "members_seen_in_period": _seen(PERIOD),
    "members_before_cutoff": _seen(f"ts <= {CUTOFF} AND coalesce({MEMBER}, '') <> ''"),
    "distinct_members": f"SELECT DISTINCT member_number, name, segment, tier FROM ({ALL_MEMBERS})",
    "extract_nested": f"""
        SELECT event_id, {MEMBER} AS member_id, {VALUE} AS score, {K} AS k, NULL::VARCHAR AS below_text,
               NULL::VARCHAR AS missing, NULL::VARCHAR AS no_column FROM events""",
    "extract_strict": "SELECT event_id, event_type AS tier, props, NULL::VARCHAR AS k FROM events",
    "parse_json_documents": """
        SELECT event_type AS status, count(*) FILTER (event_id % 7 <> 0) AS n_valid,
               count(*) FILTER (event_id % 7 = 0) AS n_invalid, count(*) FILTER (event_id % 7 <> 0) AS n_tier
        FROM events GROUP BY ALL""",
    "json_scalar": f"SELECT event_id, event_type AS tier, NULL::VARCHAR AS inner, {VALUE} AS score FROM events",
    "map_reconcile": f"""
        SELECT event_id, {K} AS k, {MEMBER} AS member_number, NULL::VARCHAR AS name, event_type AS tier FROM events""",
    "map_original": f"SELECT event_id, {MEMBER} AS member_number, NULL::VARCHAR AS segment FROM events",
    "two_target_shapes": f"""
        SELECT s.shape, e.event_id, s.key,
               CASE s.nr WHEN 1 THEN e.member WHEN 2 THEN e.event_type WHEN 3 THEN e.score WHEN 4 THEN e.props END AS value
        FROM (SELECT event_id, {MEMBER} AS member, event_type, {VALUE} AS score, props FROM events) e
        CROSS JOIN (VALUES (1, 'segment', 'memberId'), (2, 'segment', 'tier'), (3, 'segment', 'score'),
                           (4, 'segment', 'props'), (5, 'segment', 'nothing'), (1, 'column', 'member_number'),
                           (2, 'column', 'tier'), (3, 'column', 'rating'), (4, 'column', 'details'),
                           (5, 'column', 'missing')) s(nr, shape, key)""",
    "segment_shape": f"""
        SELECT event_id, {MEMBER} AS "memberId", event_type AS tier, {VALUE} AS score, props, NULL::VARCHAR AS nothing FROM events""",
    "fill_schema": f"""
        SELECT event_id, {MEMBER} AS member_number, event_type AS tier, {VALUE} AS rating, props AS details,
               NULL::VARCHAR AS missing, NULL::VARCHAR AS unmapped FROM events""",
    "ignore_unknown_columns": f"SELECT o_orderkey, tier, name FROM ({ALL_MEMBERS})",
    "serialize_nested_columns": """
        SELECT event_id, '{"event_type":"' || event_type || '","user_id":' || user_id || '}' AS who,
               '{"id":' || event_id || '}' AS tags, event_type FROM events""",
    "change_record_shape": """
        SELECT event_id, '{"event_id":' || event_id || ',"event_type":"' || event_type || '","_CHANGE_TYPE":"UPSERT"}' AS record,
               '{"change_type":"UPSERT","timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') || '"}' AS row_mutation_info
        FROM events""",
    "drop_null_key_rows": """
        SELECT count(*) FILTER (event_id % 10 <> 0) AS n_rows, count(*) FILTER (event_id % 10 = 5) AS n_blank
        FROM events""",
    "cogroup_count_rows": f"""
        SELECT coalesce(n.member_number, o.member_number) AS member_number,
               coalesce(n.n, 0) AS n_new, coalesce(o.n, 0) AS n_old
        FROM (SELECT {MEMBER} AS member_number, count(*) AS n FROM events WHERE event_id % 10 <> 0 GROUP BY 1) n
        FULL JOIN (SELECT member_number, count(*) AS n FROM ({MEMBERS}) GROUP BY 1) o USING (member_number)""",
    "cogroup_all_rows": f"""
        SELECT {MEMBER} AS member_number, 'new' AS alias, event_id AS row_id
        FROM events WHERE event_id % 10 <> 0
        UNION ALL SELECT member_number, 'old', o_orderkey FROM ({MEMBERS})""",
    "reconcile_members": f"""
        SELECT n.k, n.member_number, NULL::VARCHAR AS name, o.segment, n.tier
        FROM ({LATEST_MAPPED}) n LEFT JOIN ({LATEST_MEMBERS}) o USING (member_number)""",
    "reconcile_mixed_flags": f"""
        SELECT n.member_number, n.k, o.segment, o.name,
               CASE WHEN o.member_number IS NOT NULL THEN o.tier ELSE n.tier END AS tier
        FROM ({LATEST_MAPPED}) n LEFT JOIN ({LATEST_MEMBERS}) o USING (member_number)""",
    "normalize_strings": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority ELSE '' END AS priority,
               CAST(o_custkey AS VARCHAR) AS o_custkey, CAST(round(o_totalprice * 1000, 1) AS VARCHAR) AS price,
               CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END AS even, '' AS absent FROM orders""",
    "normalize_dates": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 8 < 4 THEN strftime(o_orderdate, '%Y-%m-%d') END AS d FROM orders""",
    "normalize_timestamps": """
        SELECT event_id, CAST(CASE WHEN event_id % 8 IN (0, 2) THEN ts
                              WHEN event_id % 8 IN (1, 3, 4) THEN date_trunc('second', ts) END AS VARCHAR) AS t
        FROM events""",
    "normalize_epoch": """
        SELECT event_id, CAST(CASE event_id % 5 WHEN 0 THEN date_trunc('second', ts)
                                WHEN 1 THEN date_trunc('millisecond', ts) WHEN 2 THEN date_trunc('second', ts)
                                WHEN 4 THEN TIMESTAMP '1970-01-01 00:00:00' - to_seconds(event_id) END AS VARCHAR) AS t
        FROM events""",
    "normalize_bools": """
        SELECT event_id, CASE WHEN event_id % 9 < 3 THEN 'true' WHEN event_id % 9 IN (3, 5, 6, 7) THEN 'false' END AS b
        FROM events""",
    "normalize_ints": """
        SELECT l_orderkey, count(i) AS n_whole, CAST(sum(i) AS VARCHAR) AS sum_whole,
               CAST(sum(CAST(trunc(l_extendedprice) AS BIGINT)) AS BIGINT) AS sum_truncated
        FROM (SELECT l_orderkey, l_extendedprice,
                     CASE l_orderkey % 7 WHEN 0 THEN l_partkey WHEN 1 THEN l_partkey WHEN 3 THEN -l_partkey END AS i
              FROM lineitem) GROUP BY l_orderkey""",
    "normalize_doubles": """
        SELECT o_orderkey, CAST(CASE o_orderkey % 7 WHEN 0 THEN CAST(o_totalprice AS DECIMAL(24,6))
                                  WHEN 1 THEN CAST(o_custkey * 100 AS DECIMAL(24,6))
                                  WHEN 5 THEN CAST('0.' || o_custkey AS DECIMAL(24,6)) END AS VARCHAR) AS x
        FROM orders""",
    "normalize_decimals": """
        SELECT o_orderkey, CAST(CASE o_orderkey % 4 WHEN 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(38,9))
                                  WHEN 1 THEN CAST(o_custkey || '.123456789' AS DECIMAL(38,9)) END AS VARCHAR) AS x
        FROM orders""",
    "window_paths": f"""
        SELECT {FOLDER} AS window_path, CAST({WINDOW_END} AS VARCHAR) AS window_end, count(*) AS n_rows
        FROM events GROUP BY ALL""",
    "rows_per_folder": f"SELECT {FOLDER} AS folder, count(*) AS n_rows FROM events GROUP BY ALL",
    "latest_cells": f"""
        SELECT row_key, family, qualifier, CAST(ts AS VARCHAR) AS ts, hex(value) AS value_hex FROM ({LATEST_CELLS})""",
    "decode_cells": f"""
        SELECT row_key, '{{' || string_agg('"' || qualifier || '":' || js, ',' ORDER BY qualifier) || '}}' AS profiles,
               '{{}}' AS absent
        FROM ({LATEST_CELLS}) GROUP BY row_key""",
    "decode_whole_documents": r"""
        SELECT CAST(event_id AS VARCHAR) AS row_key,
               CASE event_id % 6 WHEN 0 THEN props WHEN 1 THEN '{"data":[' || props || ']}'
                 WHEN 2 THEN '{"value":"' || event_type || '"}' WHEN 3 THEN '{"value":"ff00ab"}'
                 WHEN 4 THEN '{"value":"{' || replace(props, '"', '\"') || '"}' ELSE '{"value":""}' END AS profiles
        FROM events""",
    "cells_by_range": f"""
        SELECT event_id, row_key, qualifier FROM ({CELLS})
        WHERE (row_key >= '1' AND row_key < '2') OR row_key >= '95'""",
    "cells_of_keys": f"""
        SELECT event_id, row_key, qualifier FROM ({CELLS})
        WHERE row_key IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'MACHINERY')""",
    "flatten_cells": f"""
        SELECT row_key, max(txt) FILTER (qualifier = 'click') AS profiles_click,
               max(txt) FILTER (qualifier = 'view') AS profiles_view, NULL::VARCHAR AS other_click
        FROM ({LATEST_CELLS}) WHERE qualifier IN ('click', 'view') GROUP BY row_key""",
    "lookup_all_qualifiers": f"""
        SELECT row_key, family || ':' || qualifier AS qualifier, txt AS value FROM ({LATEST_CELLS})""",
    "enrich_by_key": f"""
        SELECT CAST(event_id AS VARCHAR) AS message_id, CAST(user_id AS VARCHAR) AS persona_id, member_id
        FROM ({FOUND})""",
    "message_keys": """
        SELECT CAST(user_id AS VARCHAR) AS persona_id, count(*) AS n_messages FROM events
        WHERE event_id % 13 NOT IN (0, 1) GROUP BY ALL""",
    "upsert_members": f"""
        SELECT member_number, tier FROM (
          SELECT * FROM ({CHANGES})
          QUALIFY row_number() OVER (PARTITION BY member_number ORDER BY ts DESC NULLS LAST, event_id DESC) = 1)
        WHERE change <> 'DELETE'""",
    "upsert_table": f"""
        SELECT member_number, tier FROM (
          SELECT * FROM ({CHANGES})
          QUALIFY row_number() OVER (
            PARTITION BY member_number ORDER BY pass DESC, ts DESC NULLS LAST, event_id DESC) = 1)
        WHERE change <> 'DELETE'""",
    "upsert_buckets": f"""
        SELECT member_number, tier FROM (
          SELECT * FROM ({CHANGES})
          QUALIFY row_number() OVER (
            PARTITION BY member_number ORDER BY pass DESC, ts DESC NULLS LAST, event_id DESC) = 1)
        WHERE change <> 'DELETE'""",
    "route_retry_dlq": f"SELECT route, count(*) AS n_rows FROM ({ROUTED}) GROUP BY ALL",
    "retry_messages": f"""
        SELECT CAST(event_id AS VARCHAR) AS message_id, data, 'no persona id' AS error, CAST(tries + 1 AS INTEGER) AS retry_count,
               '2024-02-01 00:00:00' AS timestamp FROM ({ROUTED}) WHERE route = 'retry'""",
    "dead_letters": """
        SELECT CAST(event_id AS VARCHAR) AS message_id,
               CASE WHEN event_id % 19 = 3 THEN '//57' WHEN event_id % 13 = 0 THEN '{bad' ELSE '{}' END AS data,
               CASE WHEN event_id % 19 = 3 THEN 'base64' ELSE 'utf-8' END AS data_encoding, 'no persona id' AS error,
               event_id % 5 AS retry_count, true AS final_failure
        FROM events
        WHERE event_id % 5 >= 3 AND (event_id % 19 = 3 OR (event_id % 17 <> 2 AND event_id % 13 IN (0, 1)))""",
    "partitioned_roundtrip": f"""
        SELECT member_number, name, tier, o_orderkey, '202402' AS par_month, '01' AS par_day, '01' AS par_hour,
               '2024020101' AS run_dt FROM ({ALL_MEMBERS})""",
    "sharded_write": f"""
        SELECT 'all' AS scope, CAST(5 AS BIGINT) AS n_files, count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS sum_key
        FROM ({ALL_MEMBERS})""",
    "json_roundtrip": f"SELECT member_number, name, o_orderkey FROM ({ALL_MEMBERS})",
    "text_roundtrip": f"SELECT o_orderkey || ' ' || name AS line FROM ({ALL_MEMBERS})",
    "snapshot_load": f"SELECT member_number, o_orderkey FROM ({ALL_MEMBERS})",
    "table_append": f"SELECT member_number, o_orderkey FROM ({ALL_MEMBERS})",
    "table_append_ignoring": f"SELECT member_number, o_orderkey FROM ({ALL_MEMBERS})",
    "high_water_mark": f"""
        SELECT event_id, CAST(ts AS VARCHAR) AS ts FROM events
        WHERE ts > (SELECT max(ts) FROM events WHERE ts <= {CUTOFF})""",
    "query_source": f"""
        SELECT user_id, event_id, event_type FROM events WHERE ts <= {CUTOFF}
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "record_count": """
        SELECT count(*) AS n_rows FROM events
        WHERE user_id = (SELECT user_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 1)""",
    "reconcile_backfill": _reconciled(f"ts <= {CUTOFF} AND coalesce(member_number, '') <> ''"),
    "reconcile_incremental": _reconciled(f"{PERIOD} AND member_number IS NOT NULL"),
    "reconcile_since_mark": _reconciled(
        f"ts > (SELECT max(ts) FROM events WHERE ts <= {CUTOFF}) AND member_number IS NOT NULL"),
    "reconcile_with_step": f"""
        SELECT member_number, k FROM (
          {_reconciled(f"ts <= {CUTOFF} AND coalesce(member_number, '') <> ''", "CAST(n.k AS BIGINT) + 1000")})""",
    "reconcile_backfill_written": f"""
        SELECT CASE WHEN event_id % 10 = 5 THEN '' ELSE CAST(user_id AS VARCHAR) END AS member_number,
               CAST(CAST(ts AS DATE) AS VARCHAR) AS joined, strftime(ts, '%Y-%m-%d %H:%M:%S') AS seen,
               event_id % 2 = 0 AS active, value AS score, event_id || '.25' AS amount, event_id % 7 AS visits,
               '2024020101' AS run_dt
        FROM events WHERE ts <= {CUTOFF} AND event_id % 10 <> 5
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "stream_dedup_window": f"""
        SELECT strftime({WINDOW_END}, '%m') AS par_month, strftime({WINDOW_END}, '%d') AS par_day,
               strftime({WINDOW_END}, '%H') AS par_hour, strftime({WINDOW_END}, '%Y%m%d%H') AS run_dt,
               count(*) AS n_rows, count(*) AS n_messages
        FROM events WHERE dayofmonth(ts) >= 6 GROUP BY ALL""",
    "stream_realtime": f"""
        SELECT sink, member, tier, count(*) AS n_rows FROM (
          SELECT 'rows' AS sink, member_id AS member, CASE WHEN dayofmonth(ts) <= 15 THEN event_type END AS tier FROM ({FOUND})
          UNION ALL
          SELECT 'windows', member_id, CASE WHEN dayofmonth(ts) <= 15 THEN event_type ELSE {VALUE} END FROM ({FOUND})
          UNION ALL
          SELECT 'dead', NULL, 'processing_error' FROM events WHERE event_id % 13 IN (0, 1))
        GROUP BY ALL""",
    "stream_errors": f"""
        SELECT outcome, data_encoding, count(*) AS n_messages FROM (
          SELECT CASE WHEN odd OR (NOT blank AND event_id % 13 IN (0, 1)) OR blank THEN 'no key in the message'
                      WHEN member_id <> '' THEN 'row' ELSE 'no document' END AS outcome,
                 CASE WHEN odd THEN 'base64' WHEN blank OR event_id % 13 IN (0, 1) THEN 'utf-8' END AS data_encoding
          FROM (SELECT event_id, user_id, event_id % 19 = 3 AS odd, event_id % 17 = 2 AS blank FROM events)
          LEFT JOIN (SELECT user_id, member_id FROM ({LATEST_DOCUMENTS})) USING (user_id))
        GROUP BY ALL
        UNION ALL SELECT 'no document', NULL, 0 WHERE NOT EXISTS (
          SELECT 1 FROM events JOIN ({LATEST_DOCUMENTS}) d USING (user_id)
          WHERE coalesce(d.member_id, '') = '' AND events.event_id % 19 <> 3 AND events.event_id % 17 <> 2
            AND events.event_id % 13 NOT IN (0, 1))""",
}
