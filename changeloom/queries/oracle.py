"""The SQL each registered query must agree with, over the same tables."""

from __future__ import annotations

_RAW = """raw AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 50 = 0 THEN 'bad' ELSE CAST(o_orderkey AS VARCHAR) END AS order_id,
         CASE WHEN o_custkey % 40 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS cust_id,
         CASE WHEN o_orderkey % 7 = 0 THEN 'x1' ELSE CAST(o_orderkey % 100 AS VARCHAR) END AS score,
         o_orderstatus AS status, o_orderdate AS dms_timestamp
  FROM orders)"""

_CAST = (
    _RAW
    + """, cast_rows AS (
  SELECT TRY_CAST(order_id AS BIGINT) AS order_id, TRY_CAST(cust_id AS BIGINT) AS cust_id,
         TRY_CAST(score AS INTEGER) AS score, status, dms_timestamp
  FROM raw)"""
)

_TAGGED = (
    _CAST
    + """, tagged AS (
  SELECT *, CASE WHEN order_id IS NULL THEN 'type_cast'
                 WHEN cust_id IS NULL THEN 'null_check'
                 WHEN status IS NOT NULL AND status NOT IN ('O', 'F') THEN 'enum_check'
                 ELSE 'valid' END AS rule
  FROM cast_rows)"""
)

# numbers that may be NULL are compared as text
_SHOWN = (
    "CAST(order_id AS VARCHAR) AS order_id, CAST(cust_id AS VARCHAR) AS cust_id, "
    "CAST(score AS VARCHAR) AS score, status"
)
_USER = "user_id, event_type, CAST(event_id AS VARCHAR) AS event_id"

_CHG = """chg AS (
  SELECT user_id, event_type, event_id,
         CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op,
         ts AS dms_timestamp
  FROM events)"""

_LATEST = (
    _CHG
    + """, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id
                               ORDER BY dms_timestamp DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
  FROM chg), latest AS (SELECT * FROM ranked WHERE rn = 1)"""
)

_MERGE = (
    _LATEST
    + """, base AS (
  SELECT c_custkey * 2 AS user_id, c_mktsegment AS event_type, CAST(NULL AS BIGINT) AS event_id
  FROM customer), merged AS (
  SELECT coalesce(l.user_id, b.user_id) AS user_id,
         CASE WHEN l.user_id IS NULL THEN b.event_type ELSE l.event_type END AS event_type,
         CASE WHEN l.user_id IS NULL THEN b.event_id ELSE l.event_id END AS event_id,
         l.op AS op, b.user_id IS NOT NULL AS was_there, l.user_id IS NOT NULL AS changed
  FROM base b FULL OUTER JOIN latest l ON b.user_id = l.user_id)"""
)

_STATE = f"WITH {_MERGE} SELECT {_USER} FROM merged WHERE op IS NULL OR op <> 'D'"

_EVENT_REJECTS = """SELECT 'tbl_users' AS _reject_table, 'enum_check' AS _reject_rule, user_id, event_id
  FROM events WHERE event_type = 'purchase'"""

_ORDER_COUNTS = "count(*) AS n, count(*) FILTER (WHERE rule = 'valid') AS n_valid"

ORACLE: dict[str, str] = {
    "scan_batch": "SELECT * FROM orders",
    "scan_glob": "SELECT * FROM orders",
    "scan_recursive": "SELECT * FROM orders",
    "compact": "SELECT * FROM orders",
    "compact_small": "SELECT * FROM orders",
    "stream_scan": "SELECT * FROM events",
    "catalog_read": "SELECT o_orderstatus, count(*) AS n_orders FROM orders GROUP BY o_orderstatus",
    "sql_query": "SELECT o_orderstatus, count(*) AS n_orders, min(o_orderkey) AS first_order "
    "FROM orders GROUP BY o_orderstatus",
    "dq_type_map": """
SELECT o_orderkey, number AS c_string, o_orderstatus AS c_varchar, o_orderstatus AS c_char,
       o_orderkey AS c_bigint, CAST(o_orderkey AS INTEGER) AS c_integer,
       CAST(o_orderkey AS INTEGER) AS c_int, CAST(o_orderkey AS INTEGER) AS c_smallint,
       o_totalprice AS c_double, o_totalprice AS c_float,
       CAST(CAST(price AS DECIMAL(38, 18)) AS VARCHAR) AS c_decimal,
       truth AS c_boolean, truth AS c_bool, o_orderdate AS c_timestamp, o_orderdate AS c_timestamptz,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS c_date, price AS c_geometry
FROM (SELECT *, CAST(o_orderkey AS VARCHAR) AS number, CAST(o_totalprice AS VARCHAR) AS price,
             CASE o_orderstatus WHEN 'F' THEN 'false' WHEN 'O' THEN 'true' END AS truth
      FROM orders) t""",
    "dq_cast": f"WITH {_CAST} SELECT {_SHOWN}, dms_timestamp, "
    "'bigint bigint int string' AS types FROM cast_rows",
    "dq_cast_reject": f"WITH {_TAGGED} SELECT {_SHOWN}, dms_timestamp "
    "FROM tagged WHERE rule = 'type_cast'",
    "dq_null_check": f"WITH {_TAGGED} SELECT {_SHOWN}, dms_timestamp "
    "FROM tagged WHERE rule = 'null_check'",
    "dq_enum_check": f"WITH {_TAGGED} SELECT {_SHOWN}, dms_timestamp "
    "FROM tagged WHERE rule = 'enum_check'",
    "dq_split": f"WITH {_TAGGED} SELECT {_SHOWN}, dms_timestamp, rule FROM tagged",
    "dq_counts": f"WITH {_TAGGED} SELECT rule, count(*) AS n_rows FROM tagged GROUP BY rule",
    "dq_strict_cast": f"""
WITH {_RAW}
SELECT CAST(TRY_CAST(order_id AS BIGINT) AS VARCHAR) AS order_id,
       CAST(TRY_CAST(cust_id AS BIGINT) AS VARCHAR) AS cust_id,
       CAST(TRY_CAST(score AS INTEGER) AS VARCHAR) AS score, status,
       CASE WHEN TRY_CAST(order_id AS BIGINT) IS NULL OR score = 'x1' THEN 'type_cast'
            WHEN cust_id IS NULL THEN 'null_check'
            WHEN status NOT IN ('O', 'F') THEN 'enum_check'
            WHEN status = 'O' THEN 'timestamp_check'
            ELSE 'valid' END AS rule
FROM raw""",
    "dq_key_only_deletes": """
SELECT 'checked' AS mode, CASE WHEN event_type = 'error' THEN 'null_check' ELSE 'valid' END AS rule,
       count(*) AS n_rows
FROM events GROUP BY 1, 2
UNION ALL
SELECT 'spared' AS mode, 'valid' AS rule, count(*) AS n_rows FROM events""",
    "dq_rejects": f"""
WITH {_TAGGED}
SELECT {_SHOWN}, dms_timestamp, 'tbl_orders' AS _reject_table,
       rule AS _reject_rule, TIMESTAMP '2026-06-30 10:00:00' AS _reject_timestamp
FROM tagged WHERE rule <> 'valid'""",
    "reject_union": f"""
WITH {_TAGGED}
SELECT 'tbl_orders' AS _reject_table, rule AS _reject_rule, {_SHOWN},
       CAST(NULL AS VARCHAR) AS user_id, CAST(NULL AS VARCHAR) AS event_id
FROM tagged WHERE rule <> 'valid'
UNION ALL
SELECT _reject_table, _reject_rule, NULL, NULL, NULL, NULL,
       CAST(user_id AS VARCHAR), CAST(event_id AS VARCHAR)
FROM ({_EVENT_REJECTS}) e""",
    "reject_sink": f"""
WITH {_TAGGED}
SELECT 'first' AS batch_id, 'tbl_orders' AS _reject_table, rule AS _reject_rule, count(*) AS n_rows
FROM tagged WHERE rule <> 'valid' GROUP BY rule
UNION ALL
SELECT 'second', _reject_table, _reject_rule, count(*)
FROM ({_EVENT_REJECTS}) e GROUP BY _reject_table, _reject_rule""",
    "merge_key": "SELECT l_orderkey, l_linenumber, concat_ws('_', l_orderkey, l_linenumber) AS cod_unique "
    "FROM lineitem",
    "partition_date": "SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS event_date, count(*) AS n_rows "
    "FROM orders GROUP BY 1",
    "partition_date_cdc": "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, count(*) AS n_rows "
    "FROM events GROUP BY 1",
    "partition_layout": "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, count(*) AS n_rows, "
    "min(event_id) AS first_event FROM events GROUP BY 1",
    "cdc_rename": f"WITH {_CHG} SELECT user_id, event_type, event_id, op AS cdc_operation, "
    "dms_timestamp AS cdc_timestamp FROM chg",
    "cdc_project": f"WITH {_CHG} SELECT user_id, event_type, op AS cdc_operation FROM chg",
    "latest_change": f'WITH {_LATEST} SELECT user_id, event_type, event_id, op AS "Op", dms_timestamp '
    "FROM latest",
    "duplicate_keys": "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem "
    "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
    "merge_bootstrap": f"WITH {_LATEST} SELECT user_id, event_type, event_id FROM latest WHERE op <> 'D'",
    "merge_insert": f"WITH {_MERGE} SELECT user_id, event_type, event_id FROM merged "
    "WHERE changed AND NOT was_there AND op <> 'D'",
    "merge_update": f"WITH {_MERGE} SELECT user_id, event_type, event_id FROM merged "
    "WHERE changed AND was_there AND op <> 'D'",
    "merge_delete": f"WITH {_MERGE} SELECT user_id, event_type, event_id FROM merged "
    "WHERE changed AND was_there AND op = 'D'",
    "merge_effects": f"""
WITH {_MERGE}
SELECT CASE WHEN op = 'D' AND was_there THEN 'delete' WHEN op = 'D' THEN 'unknown_delete'
            WHEN was_there THEN 'update' ELSE 'insert' END AS effect, count(*) AS n_changes
FROM merged WHERE changed GROUP BY 1""",
    "merge_apply": _STATE,
    "merge_apply_join": _STATE,
    "merge_apply_shuffle": _STATE,
    "merge_sink_roundtrip": _STATE,
    "late_change_guard": _STATE,
    "stream_apply": _STATE,
    "merge_ties": f"""
WITH {_CHG}, ranked AS (
  SELECT *, CAST(dms_timestamp AS DATE) AS day,
         row_number() OVER (PARTITION BY user_id ORDER BY CAST(dms_timestamp AS DATE) DESC, op = 'D' DESC,
           md5(concat_ws('|', user_id, event_type, event_id, CAST(dms_timestamp AS DATE))) DESC) AS rn
  FROM chg),
state AS (
  SELECT user_id, event_type, CAST(event_id AS VARCHAR) AS event_id FROM ranked WHERE rn = 1 AND op <> 'D'
  UNION ALL
  SELECT c_custkey * 2, c_mktsegment, NULL FROM customer
  WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey * 2))
SELECT state.*, way FROM state, (VALUES ('join'), ('shuffle'), ('three batches'), ('reversed')) AS ways(way)""",
    "load_soft_delete": f"WITH {_LATEST} SELECT {_USER}, CAST(op = 'D' AS INTEGER) AS is_deleted FROM latest",
    "run_throughput": """
SELECT 'orders' AS source, CAST(1 AS BIGINT) AS runs, count(*) AS records_read,
       1 AS has_longest_run, 1 AS has_rate FROM orders""",
    "rebucket": "SELECT o_orderkey, o_custkey, lower(o_orderstatus) AS o_orderstatus FROM orders",
    "dq_empty": f"""
WITH {_TAGGED}, totals AS (SELECT {_ORDER_COUNTS} FROM tagged)
SELECT 'all' AS input, 'valid' AS half, n_valid AS n_rows, 5 AS n_columns FROM totals
UNION ALL SELECT 'all', 'rejects', n - n_valid, 8 FROM totals
UNION ALL SELECT 'none', 'valid', 0, 5 UNION ALL SELECT 'none', 'rejects', 0, 8""",
    "fk_orphans_incremental": """
SELECT o_orderkey, o_custkey
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey
      FROM orders WHERE o_orderkey % 10 <> 5) o
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey
                  AND (c_custkey % 3 = 2 OR c_custkey % 6 = 0 OR c_custkey % 9 = 1))""",
    "table_probe": "SELECT 0 AS before, 1 AS after, count(*) AS n_rows FROM customer",
    "merge_upsert_no_op": f"WITH {_MERGE} SELECT {_USER} FROM merged",
    "merge_soft_delete": f"WITH {_MERGE} SELECT {_USER}, "
    "CAST(coalesce(op, 'I') = 'D' AS INTEGER) AS is_deleted FROM merged",
    "stream_batch_counts": "SELECT 'users' AS source, 'success' AS status, count(*) AS records_read, "
    "count(*) AS records_written, CAST(0 AS BIGINT) AS records_rejected FROM events",
    "stream_restart": f"SELECT count(*) AS n_users, CAST(sum(CAST(event_id AS BIGINT)) AS BIGINT) AS event_id_sum, "
    f"(SELECT count(*) FROM events) AS records_read FROM ({_STATE}) s",
    "stream_multi_table": f"""
WITH {_TAGGED}, {_LATEST}
SELECT 'tbl_orders' AS table_name, count(*) AS n_rows FROM tagged WHERE rule = 'valid'
UNION ALL
SELECT 'tbl_users', count(*) FROM latest WHERE op <> 'D'""",
    "batch_load": f"""
WITH {_TAGGED}
SELECT order_id, cust_id, CAST(score AS VARCHAR) AS score, status, dms_timestamp AS cdc_timestamp,
       CAST(order_id AS VARCHAR) AS cod_unique,
       CAST(CAST(dms_timestamp AS DATE) AS VARCHAR) AS event_date
FROM tagged WHERE rule = 'valid'""",
    "load_by_format": f"""
WITH {_TAGGED}
SELECT order_id, cust_id, CAST(score AS VARCHAR) AS score, status, dms_timestamp AS cdc_timestamp,
       CAST(order_id AS VARCHAR) AS cod_unique,
       CAST(CAST(dms_timestamp AS DATE) AS VARCHAR) AS event_date
FROM tagged WHERE rule = 'valid'""",
    "load_then_catalog": f"""
WITH {_TAGGED}, totals AS (SELECT {_ORDER_COUNTS} FROM tagged)
SELECT 'db_raw.tbl_orders' AS table_name, n_valid AS n_rows,
       (SELECT CAST(sum(order_id) AS BIGINT) FROM tagged WHERE rule = 'valid') AS total FROM totals
UNION ALL SELECT 'db_raw.etl_control', CAST(1 AS BIGINT), n FROM totals
UNION ALL SELECT 'db_raw.data_quality_metrics', CAST(4 AS BIGINT), n_valid FROM totals""",
    "target_partition_move": """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 = 0 THEN 2 ELSE 1 END AS version,
       CAST(CAST(date_trunc('month', o_orderdate)
            + CASE WHEN o_orderkey % 10 = 0 THEN INTERVAL 2 MONTH ELSE INTERVAL 0 MONTH END AS DATE) AS VARCHAR) AS event_month
FROM orders WHERE o_orderkey % 30 <> 0""",
    "run_log": f"""
WITH {_TAGGED}, totals AS (SELECT {_ORDER_COUNTS} FROM tagged)
SELECT 'changeloom' AS job_name, 'orders' AS source, 'success' AS status, n AS records_read,
       n_valid AS records_written, n - n_valid AS records_rejected,
       'event_date=' AS target_partition, '' AS error_message
FROM totals""",
    "quality_metrics": f"""
WITH {_TAGGED}, totals AS (SELECT {_ORDER_COUNTS} FROM tagged), metrics AS (
  SELECT 'rows_read' AS metric, CAST(n AS VARCHAR) AS shown FROM totals
  UNION ALL SELECT 'rows_written', CAST(n_valid AS VARCHAR) FROM totals
  UNION ALL SELECT 'rows_rejected', CAST(n - n_valid AS VARCHAR) FROM totals
  UNION ALL SELECT 'pipeline_status', 'success' FROM totals)
SELECT 'db_raw' AS database, 'tbl_orders' AS "table", metric, metric AS rule, 'success' AS status,
       shown AS failure_reason, 'event_date=' AS partition, 'spark' AS technology
FROM metrics""",
    "validity_rate": f"""
WITH {_TAGGED}, totals AS (SELECT {_ORDER_COUNTS} FROM tagged)
SELECT 'orders' AS source, n AS records_read, n_valid AS records_written,
       CAST(n_valid AS DOUBLE) / n AS validity_rate,
       CAST(CAST(n_valid AS DOUBLE) / n >= 0.99 AS INTEGER) AS meets_target
FROM totals""",
    "fk_orphans": """
SELECT o_custkey * 2 AS cust_id, count(*) AS n_rows FROM orders
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey * 2)
GROUP BY 1""",
    "column_profile": f"""
WITH {_RAW}
SELECT 'order_id' AS column_name, 1 AS required, count(*) AS n_rows,
       count(*) FILTER (WHERE order_id IS NULL) AS n_null,
       count(*) FILTER (WHERE order_id IS NOT NULL AND TRY_CAST(order_id AS BIGINT) IS NULL) AS n_bad_cast,
       0 AS n_off_list FROM raw
UNION ALL
SELECT 'cust_id', 1, count(*), count(*) FILTER (WHERE cust_id IS NULL),
       count(*) FILTER (WHERE cust_id IS NOT NULL AND TRY_CAST(cust_id AS BIGINT) IS NULL), 0 FROM raw
UNION ALL
SELECT 'score', 0, count(*), count(*) FILTER (WHERE score IS NULL),
       count(*) FILTER (WHERE score IS NOT NULL AND TRY_CAST(score AS INTEGER) IS NULL), 0 FROM raw
UNION ALL
SELECT 'status', 0, count(*), count(*) FILTER (WHERE status IS NULL), 0,
       count(*) FILTER (WHERE status NOT IN ('O', 'F')) FROM raw""",
    "profile_merged": f"WITH {_TAGGED}, valid AS (SELECT * FROM tagged WHERE rule = 'valid') "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) AS n_rows, count(*) - count({name}) AS n_null, "
        + ", ".join(
            f"CAST({value if shown else 'NULL'} AS VARCHAR) AS {label}"
            for value, label, shown in (
                (f"min({name})", "low", name != "status"),
                (f"max({name})", "high", name != "status"),
                (f"min({name})", "low_text", name == "status"),
                (f"max({name})", "high_text", name == "status"),
            )
        )
        + ", 1 AS distinct_ok, 1 AS median_ok FROM valid"
        for name in ("order_id", "cust_id", "score", "status")
    ),
    "effect_metrics": f"""
WITH {_MERGE}
SELECT 'keys_' || CASE WHEN op = 'D' AND was_there THEN 'delete' WHEN op = 'D' THEN 'unknown_delete'
                       WHEN was_there THEN 'update' ELSE 'insert' END AS metric, count(*) AS n_keys
FROM merged WHERE changed GROUP BY 1""",
    "audit_merge": "SELECT way, 3 AS merged, 1 AS folders, CAST(3 AS BIGINT) AS n_runs, count(*) AS records_read "
    "FROM orders, (VALUES ('path'), ('name')) AS ways(way) GROUP BY way",
    "tombstone_purge": f"""
WITH {_MERGE}
SELECT m.user_id, m.event_type, CAST(m.event_id AS VARCHAR) AS event_id,
       CAST(coalesce(m.op, 'I') = 'D' AS INTEGER) AS is_deleted
FROM merged m LEFT JOIN latest l ON m.user_id = l.user_id
WHERE NOT coalesce(m.op = 'D' AND day(l.dms_timestamp) <= 15
                   AND l.dms_timestamp < (SELECT max(ts) FROM events) - INTERVAL 10 DAY, false)""",
    "stream_progress": "SELECT 'stream-orders' AS stream, count(*) AS input_rows, 1 AS one_file_each, 1 AS meets_target "
    "FROM orders",
    "stream_fair": "SELECT 'stream-orders' AS stream, count(*) AS input_rows, CAST(1 AS BIGINT) AS place "
    "FROM orders WHERE o_orderstatus = 'P' "
    "UNION ALL SELECT 'stream-users', count(*), CAST(2 AS BIGINT) FROM events",
    "stream_archive": "SELECT count(*) AS n_rows, CAST(sum(event_id) AS BIGINT) AS event_id_sum, 1 AS some_archived "
    "FROM events",
    "scan_mode": "SELECT 'batch' AS mode, 0 AS is_stream, count(*) AS n_rows FROM orders "
    "UNION ALL SELECT 'streaming', 1, count(*) FROM events",
    "dq_no_rejects": f"""
WITH {_TAGGED}, totals AS (SELECT {_ORDER_COUNTS} FROM tagged)
SELECT 'clean' AS input, 1 AS same_shape, CAST(0 AS BIGINT) AS n_rejects
UNION ALL SELECT 'damaged', 1, n - n_valid FROM totals""",
    "stream_fail_fast": f"""
WITH {_LATEST}
SELECT 1 AS raised, 0 AS still_running, count(*) AS n_users, CAST(1 AS BIGINT) AS failed_runs FROM latest WHERE op <> 'D'""",
}
# the batch load of several tables ends in the same state as streaming them
ORACLE["multi_table_load"] = ORACLE["stream_multi_table"]
# files that land twice change nothing
ORACLE["stream_redelivery"] = ORACLE["stream_restart"]
