"""DuckDB SQL that recomputes each registered query from the driver tables.

The SQL restates the fixture derivations (FIXTURES section B) and each operator's
meaning independently of the Spark code; shared CTEs are plain text fragments.
"""

from __future__ import annotations

# B1 change log, flattened: one row per event with the envelope facts as columns.
CHANGE_LOG = """
ev AS (
  SELECT event_id, user_id, event_type, value, props,
         CASE WHEN user_id % 2 = 0 THEN 'store' ELSE 'billing' END AS db,
         'tb_' || event_type AS tbl,
         CASE WHEN event_id % 10 = 0 THEN 'r' WHEN event_id % 10 = 1 THEN 'c'
              WHEN event_id % 10 = 9 THEN 'd' ELSE 'u' END AS op,
         epoch_us(ts) // 1000 AS src_ms,
         epoch_us(ts) AS src_us
  FROM events
),
cl AS (
  SELECT 'local.' || db || '.' || tbl AS topic,
         CAST(event_id % 3 AS INTEGER) AS "partition",
         event_id AS "offset",
         event_id, user_id, event_type, value, props, db, tbl, op, src_ms, src_us,
         src_ms + event_id % 5000 AS ts_ms
  FROM ev
)"""

# After the bronze chain (C1 -> C2 -> C4 -> C5 -> C6 -> C7), before folding.
BRONZE_FLAT = CHANGE_LOG + """,
flat AS (
  SELECT topic, "partition", "offset", user_id, event_id, event_type, value, props,
         CASE op WHEN 'c' THEN 'I' WHEN 'u' THEN 'U' WHEN 'd' THEN 'D' ELSE op END AS __op,
         db AS __db, tbl AS __table, ts_ms AS last_applied_date,
         CASE WHEN op = 'd' THEN 'true' ELSE 'false' END AS __deleted,
         db || '_bronze.' || tbl AS __db_table,
         md5(CAST(user_id AS VARCHAR)) AS id_iceberg
  FROM cl
  WHERE NOT (regexp_matches(topic, '^(local.*)\\..*') AND op = 'r')
)"""

BRONZE_COLUMNS = ("__db_table, id_iceberg, \"partition\", \"offset\", user_id, event_id, event_type, value, props, "
                  "__op, __db, __table, last_applied_date")

SQL: dict[str, str] = {}

SQL["bronze_latest_state"] = f"""
WITH {BRONZE_FLAT},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY __db_table, id_iceberg
                               ORDER BY last_applied_date DESC, "offset" DESC) AS rn
  FROM flat
)
SELECT {BRONZE_COLUMNS} FROM ranked WHERE rn = 1 AND __deleted = 'false'
"""

ENVELOPE_SUMMARY = 'topic, "partition", "offset", op, ts_ms'

SQL["ignore_read_op"] = f"""
WITH {CHANGE_LOG}
SELECT {ENVELOPE_SUMMARY} FROM cl
WHERE NOT coalesce(regexp_matches(topic, '^(local.*)\\..*') AND op = 'r', false)
"""

SQL["unwrap"] = f"""
WITH {CHANGE_LOG}
SELECT topic, "partition", "offset" * 2 AS "offset", user_id, event_id, event_type, value, props,
       op AS __op, db AS __db, tbl AS __table, ts_ms AS __ts_ms,
       CASE WHEN op = 'd' THEN 'true' ELSE 'false' END AS __deleted
FROM cl
"""

SQL["drop_tombstones"] = f"""
WITH {CHANGE_LOG}
SELECT topic, "partition", "offset" * 2 AS "offset" FROM cl
"""

SQL["ts_convert"] = f"""
WITH {CHANGE_LOG}
SELECT topic, "partition", "offset", op, strftime(epoch_ms(ts_ms), '%Y-%m-%dT%H:%M:%S.%g') AS ts_ms FROM cl
"""

SQL["format_field"] = f"""
WITH {CHANGE_LOG}
SELECT "offset", db AS __db, tbl AS __table, db || '_bronze.' || tbl AS __db_table FROM cl
"""

SQL["replace_value"] = f"""
WITH {CHANGE_LOG}
SELECT "offset", CASE op WHEN 'c' THEN 'I' WHEN 'u' THEN 'U' WHEN 'd' THEN 'D' ELSE op END AS __op FROM cl
"""

SQL["replace_field"] = f"""
WITH {CHANGE_LOG}
SELECT "offset", ts_ms AS last_applied_date FROM cl
"""

SQL["hash_key"] = f"""
WITH {CHANGE_LOG}
SELECT "offset", user_id, tbl AS __table, md5(concat_ws('|', CAST(user_id AS VARCHAR), tbl)) AS id_iceberg FROM cl
"""

SQL["transform_chain"] = f"""
WITH {BRONZE_FLAT}
SELECT __db_table, id_iceberg, "partition", "offset", user_id, event_id, event_type, value, props, __op, __db,
       __table, strftime(epoch_ms(last_applied_date), '%Y-%m-%dT%H:%M:%S.%g') AS last_applied_date, __deleted
FROM flat
"""

SQL["table_include"] = f"""
WITH {CHANGE_LOG}
SELECT {ENVELOPE_SUMMARY} FROM cl WHERE db || '.' || tbl IN ('store.tb_click', 'store.tb_purchase')
"""

# B3 row images from orders.
LAKE_ROWS = """
lr AS (
  SELECT CAST(o_orderkey AS INTEGER) AS id,
         rpad(o_orderpriority, 36, ' ') AS char36,
         CAST(o_orderkey % 2 AS INTEGER) AS boolean1,
         CAST(CAST(o_orderkey % 10000 AS DECIMAL(12,8)) + CAST(0.12345678 AS DECIMAL(12,8)) AS DECIMAL(12,8))
           AS decimal1,
         CAST(epoch_us(o_orderdate) // 86400000000 AS INTEGER) AS date1,
         (o_orderkey * 1000003) % 86400000000 AS time1,
         epoch_us(o_orderdate) // 1000 + ((o_orderkey * 1000003) % 86400000000) // 1000 AS datetime1,
         epoch_us(o_orderdate) + (o_orderkey * 1000003) % 86400000000 AS create_datetime
  FROM orders
)"""

SQL["tinyint1_to_boolean"] = f"WITH {LAKE_ROWS} SELECT id, boolean1 <> 0 AS boolean1 FROM lr"
SQL["decimal_precise"] = f"WITH {LAKE_ROWS} SELECT id, decimal1 FROM lr"
SQL["normalize_char"] = f"WITH {LAKE_ROWS} SELECT id, rtrim(char36) AS char36 FROM lr"
SQL["decode_temporal"] = f"""
WITH {LAKE_ROWS}
SELECT id,
       strftime(DATE '1970-01-01' + date1, '%Y-%m-%d') AS date1,
       strftime(make_timestamp(time1), '%H:%M:%S.%f') AS time1,
       strftime(epoch_ms(datetime1), '%Y-%m-%d %H:%M:%S.%f') AS datetime1,
       strftime(make_timestamp(create_datetime), '%Y-%m-%d %H:%M:%S.%f') AS create_datetime,
       strftime(strptime(strftime(make_timestamp(create_datetime), '%Y-%m-%dT%H:%M:%S.%fZ'),
                         '%Y-%m-%dT%H:%M:%S.%fZ'), '%Y-%m-%d %H:%M:%S.%f') AS update_timestamp
FROM lr
"""

TOPICS = CHANGE_LOG + """,
topics AS (
  SELECT DISTINCT topic FROM cl
  UNION ALL
  SELECT * FROM (VALUES ('__consumer_offsets'), ('_schemas'), ('connect-configs'), ('my-connect-status-x'),
                        ('plain'), ('a.b.c.d'), ('local.store.tb_idle')) AS t(topic)
),
kept AS (
  SELECT topic FROM topics
  WHERE NOT starts_with(topic, '_') AND NOT regexp_matches(topic, 'connect-(configs|offsets|status)')
)"""

SQL["topic_filter"] = f"WITH {TOPICS} SELECT topic FROM kept"

SQL["topic_parts"] = f"""
WITH {TOPICS}
SELECT topic, split_part(topic, '.', 1) AS prefix, split_part(topic, '.', 2) AS schema,
       split_part(topic, '.', 3) AS "table"
FROM kept WHERE len(string_split(topic, '.')) = 3
"""

# Kafka records of the change log: framed unless offset % 7 = 0.
RECORDS = CHANGE_LOG + """,
rec AS (
  SELECT topic, "partition", "offset", ts_ms AS timestamp_ms, src_ms, ts_ms, "offset" % 7 <> 0 AS framed FROM cl
),
last_pp AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset" DESC) AS rn FROM rec)
  WHERE rn = 1
),
latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY timestamp_ms DESC, "partition" ASC) AS rn2
                 FROM last_pp WHERE framed)
  WHERE rn2 = 1
),
metrics AS (
  SELECT topic, split_part(topic, '.', 1) AS prefix, split_part(topic, '.', 2) AS schema,
         split_part(topic, '.', 3) AS "table", src_ms, ts_ms,
         ((ts_ms - src_ms) * 1000) / 1000000::DOUBLE AS latency,
         greatest((epoch_us(TIMESTAMP '2024-02-01 00:00:00') - ts_ms * 1000) / 1000000::DOUBLE, 0.0) AS freshness
  FROM latest
  WHERE NOT starts_with(topic, '_') AND NOT regexp_matches(topic, 'connect-(configs|offsets|status)')
    AND len(string_split(topic, '.')) = 3
)"""

SQL["last_per_partition"] = f"""
WITH {RECORDS}
SELECT topic, "partition", "offset", timestamp_ms, CASE WHEN framed THEN '00' ELSE '7B' END AS first_byte FROM last_pp
"""

SQL["avro_magic_filter"] = f"""WITH {RECORDS} SELECT topic, "partition", "offset" FROM rec WHERE framed"""

SQL["latest_per_topic"] = f"""
WITH {RECORDS}
SELECT topic, "partition", "offset", timestamp_ms FROM latest
WHERE NOT starts_with(topic, '_') AND NOT regexp_matches(topic, 'connect-(configs|offsets|status)')
"""

SQL["mixed_ts_decode"] = f"""
WITH {CHANGE_LOG}
SELECT "offset",
       CASE WHEN "offset" % 2 = 1 THEN strftime(epoch_ms(ts_ms), '%Y-%m-%dT%H:%M:%S.%g')
            ELSE CAST(ts_ms AS VARCHAR) END AS ts_text,
       ts_ms AS decoded_ms
FROM cl
"""

SQL["cdc_latency"] = f"""
WITH {RECORDS}
SELECT topic, src_ms AS source_ts_ms, ts_ms AS debezium_ts_ms, latency FROM metrics
"""

SQL["topic_freshness"] = f"WITH {RECORDS} SELECT topic, freshness FROM metrics"

SQL["schema_freshness"] = f"""
WITH {RECORDS} SELECT prefix, schema, min(freshness) AS freshness FROM metrics GROUP BY prefix, schema
"""

SQL["lag_report"] = f"""
WITH {RECORDS}
SELECT topic, prefix, schema, "table",
       strftime(epoch_ms(src_ms), '%Y-%m-%d %H:%M:%S.%f') AS source_ts,
       strftime(epoch_ms(ts_ms), '%Y-%m-%d %H:%M:%S.%f') AS debezium_ts,
       latency, freshness
FROM metrics
ORDER BY prefix || '.' || schema, freshness, topic
"""

SQL["lag_report_damaged"] = f"""
WITH {RECORDS}
SELECT metrics.topic, latency, freshness FROM metrics JOIN latest USING (topic) WHERE "offset" % 3 <> 0
"""

SQL["lag_metrics"] = f"""
WITH {RECORDS}
SELECT 'debezium_source_timestamp_seconds' AS metric, 'topic=' || topic AS labels,
       (src_ms * 1000) / 1000000::DOUBLE AS value FROM metrics
UNION ALL
SELECT 'debezium_processing_timestamp_seconds', 'topic=' || topic, (ts_ms * 1000) / 1000000::DOUBLE FROM metrics
UNION ALL
SELECT 'schema_freshness_seconds', 'prefix=' || prefix || ',schema=' || schema, min(freshness)
FROM metrics GROUP BY prefix, schema
"""

# every hourly scrape looks for the last record of each partition anew
SQL["lag_metrics_timeline"] = f"""
WITH {CHANGE_LOG},
ticks AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-01', INTERVAL 1 HOUR)) AS tk),
seen AS (
  SELECT tk, topic, "partition", max("offset") AS "offset" FROM ticks JOIN cl ON epoch_ms(ts_ms) <= tk
  WHERE NOT starts_with(topic, '_') GROUP BY ALL
),
newest AS (
  SELECT tk, topic, arg_max({{'ts_ms': ts_ms, 'src_ms': src_ms, 'offset': "offset"}}, ts_ms * 10 - "partition") AS r
  FROM seen JOIN cl USING (topic, "partition", "offset") WHERE "offset" % 7 <> 0 GROUP BY tk, topic
),
m AS (
  SELECT tk, topic, split_part(topic, '.', 1) AS prefix, split_part(topic, '.', 2) AS schema, r.src_ms AS src_ms, r.ts_ms AS ts_ms,
         greatest((epoch_us(tk) - r.ts_ms * 1000) / 1000000::DOUBLE, 0.0) AS freshness
  FROM newest WHERE r."offset" % 5 <> 0
),
gauges AS (
  SELECT tk, 'debezium_source_timestamp_seconds' AS metric, 'topic=' || topic AS labels, (src_ms * 1000) / 1000000::DOUBLE AS value FROM m
  UNION ALL
  SELECT tk, 'debezium_processing_timestamp_seconds', 'topic=' || topic, (ts_ms * 1000) / 1000000::DOUBLE FROM m
  UNION ALL
  SELECT tk, 'schema_freshness_seconds', 'prefix=' || prefix || ',schema=' || schema, min(freshness) FROM m GROUP BY tk, prefix, schema
)
SELECT strftime(tk, '%Y-%m-%d %H:%M:%S') AS "at", metric, labels, value FROM gauges
"""

ASSIGN = TOPICS + """,
assign AS (
  SELECT DISTINCT 'g' || CAST(user_id % 7 AS VARCHAR) AS group_id, topic, "partition" FROM cl
),
groups AS (
  SELECT DISTINCT group_id FROM assign UNION ALL SELECT 'g_idle'
)"""

SQL["topic_consumers"] = f"""
WITH {ASSIGN}
SELECT t.topic,
       coalesce(array_to_string(list_sort(list(a.group_id) FILTER (WHERE a.group_id IS NOT NULL)), ','), '')
         AS groups_text
FROM (SELECT DISTINCT topic FROM topics) t LEFT JOIN assign a ON t.topic = a.topic
GROUP BY t.topic
"""

SQL["consumer_topics"] = f"""
WITH {ASSIGN}
SELECT g.group_id,
       coalesce(array_to_string(list_sort(list(DISTINCT a.topic) FILTER (WHERE a.topic IS NOT NULL)), ','), '')
         AS topics_text
FROM groups g LEFT JOIN assign a ON g.group_id = a.group_id
GROUP BY g.group_id
"""

SQL["connectors_by_worker"] = """
SELECT 'w' || CAST(n_regionkey AS VARCHAR) AS worker_host,
       array_to_string(list_sort(list('c' || CAST(n_nationkey AS VARCHAR))), ',') AS connectors_text,
       count(*) AS n_connectors
FROM nation GROUP BY n_regionkey
"""

CATALOG = """
li AS (
  SELECT l_orderkey, l_linenumber, min(l_returnflag) AS flag, min(l_partkey) AS partkey,
         min(l_suppkey) AS suppkey, min(l_quantity) AS qty
  FROM lineitem GROUP BY l_orderkey, l_linenumber
),
li2 AS (
  SELECT *, ['int', 'nvarchar', 'numeric', 'datetime2', 'bit', 'money', 'varbinary', 'nchar'][partkey % 8 + 1] AS dtype
  FROM li
),
ctab AS MATERIALIZED (
  SELECT 'db' || CAST(o_custkey % 25 AS VARCHAR) AS TABLE_SCHEMA, 'tb_' || CAST(o_orderkey AS VARCHAR) AS TABLE_NAME,
         CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS TABLE_COMMENT,
         o_orderdate AS CREATE_TIME, o_orderdate + INTERVAL 1 DAY AS UPDATE_TIME,
         CAST(floor(o_totalprice) AS BIGINT) AS TABLE_ROWS, o_orderkey AS object_id, o_orderstatus AS status
  FROM orders
),
ccol AS MATERIALIZED (
  SELECT t.TABLE_SCHEMA, t.TABLE_NAME, l.l_orderkey AS object_id,
         CAST(l.l_linenumber AS INTEGER) AS ORDINAL_POSITION, CAST(l.l_linenumber AS INTEGER) AS column_id,
         CASE l.l_linenumber WHEN 7 THEN 'order' WHEN 6 THEN 'col 6'
              ELSE 'col' || CAST(l.l_linenumber AS VARCHAR) END AS COLUMN_NAME,
         CASE dtype WHEN 'nvarchar' THEN 'varchar(255)' WHEN 'nchar' THEN 'char(36)' WHEN 'numeric' THEN 'decimal(18,2)'
                    ELSE dtype END AS COLUMN_TYPE,
         CASE WHEN dtype IN ('nvarchar', 'nchar') THEN 'utf8mb4' END AS CHARACTER_SET_NAME,
         CASE WHEN dtype IN ('nvarchar', 'nchar') THEN 'utf8mb4_general_ci' END AS COLLATION_NAME,
         dtype AS DATA_TYPE,
         CAST(CASE WHEN dtype = 'nvarchar' THEN CASE WHEN suppkey % 5 = 0 THEN -1 ELSE CAST(qty * 40 AS BIGINT) END
                   WHEN dtype = 'nchar' THEN 36
                   WHEN dtype = 'varbinary' THEN CASE WHEN suppkey % 2 = 0 THEN -1 ELSE 2000 END END AS BIGINT)
           AS CHARACTER_MAXIMUM_LENGTH,
         CAST(CASE WHEN dtype = 'int' THEN 10 WHEN dtype = 'money' THEN 19 WHEN dtype = 'numeric' THEN 18 END AS BIGINT)
           AS NUMERIC_PRECISION,
         CAST(CASE WHEN dtype = 'numeric' THEN l.l_linenumber % 5 WHEN dtype = 'money' THEN 4 WHEN dtype = 'int' THEN 0
              END AS BIGINT) AS NUMERIC_SCALE,
         CASE l.l_linenumber % 4 WHEN 1 THEN '0' WHEN 2 THEN 'current_timestamp()' WHEN 3 THEN 'N/A' END AS COLUMN_DEFAULT,
         CASE WHEN flag = 'N' THEN 'NO' ELSE 'YES' END AS IS_NULLABLE,
         CASE WHEN l.l_linenumber = 1 AND l.l_orderkey % 3 = 0 THEN 'auto_increment' ELSE '' END AS EXTRA,
         CASE WHEN flag = 'R' THEN NULL WHEN flag = 'A' THEN 'accepted line''s ' || CAST(l.l_linenumber AS VARCHAR)
              ELSE 'line ' || CAST(l.l_linenumber AS VARCHAR) END AS COLUMN_COMMENT
  FROM li2 l JOIN ctab t ON t.object_id = l.l_orderkey
),
firstcol AS (SELECT object_id, min(ORDINAL_POSITION) AS first_pos FROM ccol GROUP BY object_id),
kusage AS MATERIALIZED (
  SELECT c.TABLE_SCHEMA, c.TABLE_NAME, c.COLUMN_NAME, 'PRIMARY' AS CONSTRAINT_NAME, 1 AS ORDINAL_POSITION,
         CASE WHEN c.object_id % 7 = 0 THEN 'ix_' || c.TABLE_NAME
              WHEN c.object_id % 4 = 0 THEN 'pk_' || c.TABLE_NAME
              WHEN c.object_id % 4 = 1 THEN 'CPK_' || c.TABLE_NAME
              WHEN c.object_id % 4 = 2 THEN c.TABLE_NAME || '_PK'
              ELSE 'npk_' || c.TABLE_NAME END AS MSSQL_CONSTRAINT_NAME
  FROM ccol c JOIN firstcol f ON c.object_id = f.object_id AND c.ORDINAL_POSITION = f.first_pos
  WHERE c.object_id % 5 <> 0
  UNION ALL
  SELECT TABLE_SCHEMA, TABLE_NAME, COLUMN_NAME,
         CASE WHEN object_id % 8 = 1 THEN 'UNIQUE' ELSE 'uq_name' END, 1,
         CASE WHEN object_id % 3 = 0 THEN TABLE_NAME || '_UQ' ELSE 'UQ_' || TABLE_NAME END
  FROM ccol WHERE ORDINAL_POSITION = 2 AND object_id % 4 = 1
),
cparts AS (
  SELECT object_id, CASE WHEN object_id % 2 = 0 THEN 1 ELSE 0 END AS index_id, TABLE_ROWS // 2 AS row_count FROM ctab
  UNION ALL
  SELECT object_id, CASE WHEN object_id % 2 = 0 THEN 1 ELSE 0 END, TABLE_ROWS - TABLE_ROWS // 2 FROM ctab
  UNION ALL
  SELECT object_id, 2, TABLE_ROWS FROM ctab
),
cinclude AS (SELECT TABLE_SCHEMA, TABLE_NAME FROM ctab WHERE status <> 'P'),
pkname AS (
  SELECT DISTINCT TABLE_SCHEMA, TABLE_NAME, COLUMN_NAME FROM kusage
  WHERE lower(MSSQL_CONSTRAINT_NAME) LIKE 'pk_%' OR lower(MSSQL_CONSTRAINT_NAME) LIKE 'cpk_%'
     OR lower(MSSQL_CONSTRAINT_NAME) LIKE 'npk_%' OR lower(MSSQL_CONSTRAINT_NAME) LIKE '%_pk'
     OR lower(MSSQL_CONSTRAINT_NAME) LIKE 'pk%_'
),
uqname AS (
  SELECT TABLE_SCHEMA, TABLE_NAME, COLUMN_NAME FROM kusage
  WHERE lower(MSSQL_CONSTRAINT_NAME) LIKE 'uq_%' OR lower(MSSQL_CONSTRAINT_NAME) LIKE '%_uq'
),
rowcount AS (SELECT object_id, CAST(sum(row_count) AS BIGINT) AS ROW_COUNT FROM cparts WHERE index_id IN (0, 1)
              GROUP BY object_id),
myspec AS (
  SELECT c.TABLE_SCHEMA AS DB_NAME, c.TABLE_NAME,
         CASE WHEN pk.ORDINAL_POSITION = 1 THEN t.TABLE_COMMENT END AS TABLE_COMMENT,
         c.ORDINAL_POSITION, c.COLUMN_NAME, c.COLUMN_TYPE, c.CHARACTER_SET_NAME AS CHARACTER_SET, c.COLLATION_NAME,
         c.DATA_TYPE,
         coalesce(CAST(c.CHARACTER_MAXIMUM_LENGTH AS VARCHAR),
                  CAST(c.NUMERIC_PRECISION AS VARCHAR) || ',' || coalesce(CAST(c.NUMERIC_SCALE AS VARCHAR), '0'))
           AS COLUMN_LENGTH,
         c.COLUMN_DEFAULT, c.IS_NULLABLE,
         CASE WHEN uq.COLUMN_NAME IS NOT NULL THEN 'YES' ELSE 'NO' END AS IS_UNIQUE,
         CASE WHEN c.EXTRA LIKE '%auto_increment%' THEN 'YES' ELSE 'NO' END AS IS_AUTO_INCREMENT,
         c.EXTRA AS COLUMN_EXTRA,
         CASE WHEN pk.COLUMN_NAME IS NULL THEN 'NO' ELSE 'YES' END AS PK,
         c.COLUMN_COMMENT,
         CASE WHEN pk.ORDINAL_POSITION = 1 THEN t.CREATE_TIME END AS CREATE_TIME,
         CASE WHEN pk.ORDINAL_POSITION = 1 THEN t.UPDATE_TIME END AS UPDATE_TIME,
         CASE WHEN pk.ORDINAL_POSITION = 1 THEN t.TABLE_ROWS END AS "ROW"
  FROM {cols} c
  JOIN ctab t ON c.TABLE_SCHEMA = t.TABLE_SCHEMA AND c.TABLE_NAME = t.TABLE_NAME
  LEFT JOIN (SELECT * FROM kusage WHERE CONSTRAINT_NAME = 'PRIMARY') pk
    ON c.TABLE_SCHEMA = pk.TABLE_SCHEMA AND c.TABLE_NAME = pk.TABLE_NAME AND c.COLUMN_NAME = pk.COLUMN_NAME
  LEFT JOIN (SELECT * FROM kusage WHERE CONSTRAINT_NAME = 'UNIQUE') uq
    ON c.TABLE_SCHEMA = uq.TABLE_SCHEMA AND c.TABLE_NAME = uq.TABLE_NAME AND c.COLUMN_NAME = uq.COLUMN_NAME
  WHERE (c.TABLE_SCHEMA, c.TABLE_NAME) IN (SELECT (TABLE_SCHEMA, TABLE_NAME) FROM cinclude)
),
msspec AS (
  SELECT c.TABLE_SCHEMA AS DB_NAME, c.TABLE_NAME,
         CASE WHEN c.ORDINAL_POSITION = 1 THEN t.TABLE_COMMENT END AS TABLE_COMMENT,
         c.ORDINAL_POSITION, c.COLUMN_NAME, CAST(NULL AS VARCHAR) AS COLUMN_TYPE, CAST(NULL AS VARCHAR) AS CHARACTER_SET,
         c.COLLATION_NAME, c.DATA_TYPE,
         coalesce(CAST(c.CHARACTER_MAXIMUM_LENGTH AS VARCHAR),
                  CAST(c.NUMERIC_PRECISION AS VARCHAR) || ',' || CAST(c.NUMERIC_SCALE AS VARCHAR)) AS COLUMN_LENGTH,
         c.COLUMN_DEFAULT, c.IS_NULLABLE,
         CASE WHEN uq.COLUMN_NAME IS NOT NULL THEN 'YES' ELSE 'NO' END AS IS_UNIQUE,
         CASE WHEN c.EXTRA = 'auto_increment' THEN 'YES' ELSE 'NO' END AS IS_AUTO_INCREMENT,
         CAST(NULL AS VARCHAR) AS COLUMN_EXTRA,
         CASE WHEN pk.COLUMN_NAME IS NULL THEN 'NO' ELSE 'YES' END AS PK,
         c.COLUMN_COMMENT,
         CASE WHEN c.ORDINAL_POSITION = 1 THEN t.CREATE_TIME END AS CREATE_TIME,
         CASE WHEN c.ORDINAL_POSITION = 1 THEN t.UPDATE_TIME END AS UPDATE_TIME,
         CASE WHEN c.ORDINAL_POSITION = 1 THEN r.ROW_COUNT END AS "ROW"
  FROM ccol c
  JOIN ctab t ON c.object_id = t.object_id
  LEFT JOIN pkname pk
    ON c.TABLE_SCHEMA = pk.TABLE_SCHEMA AND c.TABLE_NAME = pk.TABLE_NAME AND c.COLUMN_NAME = pk.COLUMN_NAME
  LEFT JOIN rowcount r ON c.object_id = r.object_id
  LEFT JOIN uqname uq
    ON c.TABLE_SCHEMA = uq.TABLE_SCHEMA AND c.TABLE_NAME = uq.TABLE_NAME AND c.COLUMN_NAME = uq.COLUMN_NAME
  WHERE (c.TABLE_SCHEMA, c.TABLE_NAME) IN (SELECT (TABLE_SCHEMA, TABLE_NAME) FROM cinclude)
)"""

SECOND_COLS = """
lastcol AS (SELECT object_id, max(ORDINAL_POSITION) AS last_pos FROM ccol GROUP BY object_id),
ccol2 AS (
  SELECT c.* REPLACE (CASE WHEN c.ORDINAL_POSITION = 3 THEN upper(c.COLUMN_NAME) ELSE c.COLUMN_NAME END AS COLUMN_NAME)
  FROM ccol c JOIN lastcol l ON c.object_id = l.object_id
  WHERE NOT (c.object_id % 11 = 0 AND c.ORDINAL_POSITION = l.last_pos)
)"""

CAT = CATALOG.replace("{cols}", "ccol")
_MYSPEC_BLOCK = CATALOG[CATALOG.index("myspec AS ("):CATALOG.index("msspec AS (")]
CAT2 = SECOND_COLS + ",\n" + _MYSPEC_BLOCK.replace("myspec AS", "myspec2 AS").replace("{cols}", "ccol2")
SPEC_TEXT = ("DB_NAME, TABLE_NAME, TABLE_COMMENT, ORDINAL_POSITION, COLUMN_NAME, COLUMN_TYPE, CHARACTER_SET, "
             "COLLATION_NAME, DATA_TYPE, COLUMN_LENGTH, COLUMN_DEFAULT, IS_NULLABLE, IS_UNIQUE, IS_AUTO_INCREMENT, "
             "COLUMN_EXTRA, PK, COLUMN_COMMENT, strftime(CREATE_TIME, '%Y-%m-%d %H:%M:%S') AS CREATE_TIME, "
             "strftime(UPDATE_TIME, '%Y-%m-%d %H:%M:%S') AS UPDATE_TIME, \"ROW\"")

SQL["mysql_table_spec"] = f"WITH {CAT} SELECT {SPEC_TEXT} FROM myspec ORDER BY DB_NAME, TABLE_NAME, ORDINAL_POSITION"
SQL["mssql_table_spec"] = f"WITH {CAT} SELECT {SPEC_TEXT} FROM msspec ORDER BY TABLE_NAME, ORDINAL_POSITION"
SQL["pk_columns"] = f"""WITH {CAT} SELECT concat_ws('.', DB_NAME, TABLE_NAME, COLUMN_NAME) AS pk_column
FROM msspec WHERE PK = 'YES'"""
SQL["tables_without_pk"] = f"""WITH {CAT} SELECT DB_NAME, TABLE_NAME FROM msspec GROUP BY DB_NAME, TABLE_NAME
HAVING count(*) FILTER (WHERE PK = 'YES') = 0"""
SQL["table_row_count"] = f"WITH {CAT} SELECT object_id, ROW_COUNT FROM rowcount"
SQL["pk_name_match"] = f"WITH {CAT} SELECT TABLE_SCHEMA, TABLE_NAME, COLUMN_NAME FROM pkname"
SQL["unique_name_match"] = f"WITH {CAT} SELECT TABLE_SCHEMA, TABLE_NAME, COLUMN_NAME FROM uqname"
SQL["spec_union"] = f"""WITH {CAT}
SELECT {SPEC_TEXT}, 'mysql' AS ENGINE FROM myspec
UNION ALL
SELECT {SPEC_TEXT.replace('COLUMN_EXTRA, ', 'CAST(NULL AS VARCHAR) AS COLUMN_EXTRA, ')}, 'mssql' FROM msspec"""

SQL["space_used"] = """
SELECT p_name AS name, CAST(p_size * 100 AS VARCHAR) AS rows,
       CAST(p_size * 8 AS BIGINT) AS reserved, CAST(p_size * 5 AS BIGINT) AS data,
       CAST(p_size * 2 AS BIGINT) AS index_size,
       CASE WHEN p_partkey % 13 <> 0 THEN CAST(p_size AS BIGINT) ELSE 0 END AS unused,
       'db' || CAST(p_partkey % 3 AS VARCHAR) AS db_name
FROM part
"""

TYPE_MAP = """
tm0 AS (
  SELECT DB_NAME, TABLE_NAME, COLUMN_NAME, DATA_TYPE, COLUMN_LENGTH, lower(DATA_TYPE) AS t,
         coalesce(COLUMN_LENGTH, '') AS len,
         regexp_full_match(coalesce(COLUMN_LENGTH, ''), '[0-9]+') AS digits,
         (contains(lower(DATA_TYPE), 'binary') OR lower(DATA_TYPE) = 'image') AS isbin
  FROM msspec
),
tm1 AS (
  SELECT *,
    CASE WHEN len = '' THEN t
         WHEN contains(t, 'char') AND len = '-1' THEN 'text'
         WHEN isbin AND len = '-1' THEN 'BLOB'
         WHEN t = 'hierarchyid' THEN t
         WHEN digits AND length(len) >= 4 THEN CASE WHEN isbin THEN 'BLOB' ELSE 'text' END
         ELSE t END AS rt,
    CASE WHEN len = '' THEN ''
         WHEN contains(t, 'char') AND len = '-1' THEN ''
         WHEN isbin AND len = '-1' THEN ''
         WHEN t = 'hierarchyid' THEN ''
         WHEN digits AND length(len) >= 4 THEN ''
         WHEN digits THEN '(' || len || ')'
         WHEN t IN ('numeric', 'decimal') AND contains(len, ',') THEN '(' || len || ')'
         ELSE '' END AS rl,
    (len = '' OR (contains(t, 'char') AND len = '-1') OR (isbin AND len = '-1') OR t = 'hierarchyid'
     OR (digits AND length(len) >= 4)) AS type_changed
  FROM tm0
),
tm AS (
  SELECT DB_NAME, TABLE_NAME, COLUMN_NAME, DATA_TYPE, COLUMN_LENGTH,
    trim(coalesce(CASE rt WHEN 'money' THEN 'DECIMAL(19,4)' WHEN 'smalldatetime' THEN 'DATETIME'
                          WHEN 'datetime2' THEN 'DATETIME' WHEN 'bit' THEN 'TINYINT(1)' WHEN 'nvarchar' THEN 'VARCHAR'
                          WHEN 'ntext' THEN 'TEXT' WHEN 'uniqueidentifier' THEN 'VARCHAR(64)' WHEN 'nchar' THEN 'CHAR'
                          WHEN 'hierarchyid' THEN 'VARCHAR(100)' WHEN 'tinyint' THEN 'TINYINT UNSIGNED'
                          WHEN 'xml' THEN 'LONGTEXT' WHEN 'numeric' THEN 'NUMERIC' WHEN 'decimal' THEN 'DECIMAL' END,
                  upper(rt)) || rl) AS mysql_type,
    type_changed,
    CASE WHEN t IN ('numeric', 'decimal') AND contains(len, ',')
           THEN 'decimal(' || trim(split_part(len, ',', 1)) || ',' || trim(split_part(len, ',', 2)) || ')'
         WHEN t IN ('numeric', 'decimal') THEN 'decimal(38,0)'
         WHEN t = 'money' THEN 'decimal(19,4)' WHEN t = 'bit' THEN 'boolean' WHEN t = 'int' THEN 'int'
         WHEN t = 'datetime2' THEN 'timestamp' WHEN t IN ('varbinary') THEN 'binary'
         WHEN t IN ('nvarchar', 'nchar') THEN 'string'
         ELSE 'string' END AS spark_type
  FROM tm1
)"""

SQL["type_map"] = f"WITH {CAT}, {TYPE_MAP} SELECT * FROM tm"
SQL["type_change_report"] = f"""WITH {CAT}, {TYPE_MAP}
SELECT DB_NAME, TABLE_NAME, COLUMN_NAME, DATA_TYPE, COLUMN_LENGTH, mysql_type, spark_type FROM tm WHERE type_changed"""
SQL["pk_list_per_table"] = f"""WITH {CAT}
SELECT DB_NAME, TABLE_NAME, string_agg(COLUMN_NAME, ',' ORDER BY ORDINAL_POSITION, COLUMN_NAME) AS pk_columns
FROM msspec WHERE PK = 'YES' GROUP BY DB_NAME, TABLE_NAME"""

MATCH = f"""{CAT}, {CAT2.strip()}
srcr AS (SELECT *, CAST(row_number() OVER (PARTITION BY DB_NAME, TABLE_NAME ORDER BY ORDINAL_POSITION, COLUMN_NAME)
                      AS INTEGER) AS idx
         FROM msspec),
dstr AS (SELECT *, CAST(row_number() OVER (PARTITION BY DB_NAME, TABLE_NAME ORDER BY ORDINAL_POSITION, COLUMN_NAME)
                      AS INTEGER) AS idx
         FROM myspec2),
byname AS (
  SELECT s.DB_NAME, s.TABLE_NAME, s.idx, s.COLUMN_NAME AS src_column, d.COLUMN_NAME AS dst_column,
         s.TABLE_COMMENT AS src_tc, s.COLUMN_COMMENT AS src_cc, d.COLUMN_TYPE AS d_type, d.CHARACTER_SET AS d_cs,
         d.COLLATION_NAME AS d_coll, d.IS_NULLABLE AS d_null, d.COLUMN_DEFAULT AS d_def,
         d.IS_AUTO_INCREMENT AS d_ai, d.IS_UNIQUE AS d_uq
  FROM srcr s JOIN myspec2 d ON s.DB_NAME = d.DB_NAME AND s.TABLE_NAME = d.TABLE_NAME AND s.COLUMN_NAME = d.COLUMN_NAME
)"""

SQL["comment_match_by_name"] = f"WITH {MATCH} SELECT DB_NAME, TABLE_NAME, idx, src_column, dst_column FROM byname"
SQL["comment_match_by_sequence"] = f"""WITH {MATCH}
SELECT s.DB_NAME, s.TABLE_NAME, s.idx, s.COLUMN_NAME AS src_column, d.COLUMN_NAME AS dst_column
FROM srcr s JOIN dstr d ON s.DB_NAME = d.DB_NAME AND s.TABLE_NAME = d.TABLE_NAME AND s.idx = d.idx"""
SQL["comment_rows"] = f"""WITH {MATCH}
SELECT DB_NAME, TABLE_NAME, 'table' AS kind, CAST(NULL AS VARCHAR) AS column_name, src_tc AS comment,
       'ALTER TABLE ' || DB_NAME || '.' || TABLE_NAME || ' COMMENT = ''' || replace(replace(src_tc, '\\', '\\\\'), '''', '\\''') || ''';' AS statement
FROM byname WHERE idx = 1 AND src_tc IS NOT NULL AND src_tc <> ''
UNION ALL
SELECT DB_NAME, TABLE_NAME, 'column', dst_column, src_cc,
       concat_ws(' ', 'ALTER TABLE ' || DB_NAME || '.' || TABLE_NAME || ' MODIFY COLUMN ' || dst_column || ' '
                        || coalesce(d_type, 'None'),
                 CASE WHEN d_cs IS NOT NULL AND d_cs <> '' THEN 'CHARACTER SET ' || d_cs END,
                 CASE WHEN d_coll IS NOT NULL AND d_coll <> '' THEN 'COLLATE ' || d_coll END,
                 CASE WHEN d_null = 'YES' THEN 'NULL' ELSE 'NOT NULL' END,
                 CASE WHEN d_def IS NULL THEN NULL
                      WHEN regexp_full_match(d_def, '[0-9]+') OR contains(lower(d_def), 'now')
                           OR contains(lower(d_def), 'current_timestamp') THEN 'DEFAULT ' || d_def
                      ELSE 'DEFAULT ''' || replace(replace(d_def, '\\', '\\\\'), '''', '\\''') || '''' END,
                 CASE WHEN d_ai = 'YES' THEN 'AUTO_INCREMENT' END,
                 CASE WHEN d_uq = 'YES' THEN 'UNIQUE' END,
                 'COMMENT ''' || replace(replace(src_cc, '\\', '\\\\'), '''', '\\''') || ''';')
FROM byname WHERE src_cc IS NOT NULL AND src_cc <> ''"""

SQL["bronze_comment_rows"] = f"""WITH {CAT},
bc AS (SELECT DB_NAME, TABLE_NAME, ORDINAL_POSITION, COLUMN_NAME,
              replace(coalesce(TABLE_COMMENT, ''), '''', '') AS tc, replace(coalesce(COLUMN_COMMENT, ''), '''', '') AS cc,
              lower(DB_NAME) || '_bronze.' || lower(TABLE_NAME) AS target
       FROM myspec),
firsttc AS (SELECT target, arg_min(tc, (ORDINAL_POSITION, COLUMN_NAME)) AS tc FROM bc WHERE tc <> '' GROUP BY target)
SELECT target AS target_table, CAST(NULL AS VARCHAR) AS column_name, trim(tc) AS comment,
       'ALTER TABLE ' || target || ' SET TBLPROPERTIES (''comment'' = ''' || replace(replace(trim(tc), '\\', '\\\\'), '''', '\\''') || ''');' AS statement
FROM firsttc
UNION ALL
SELECT target, COLUMN_NAME, trim(cc),
       'ALTER TABLE ' || target || ' ALTER COLUMN `' || replace(COLUMN_NAME, '`', '``') || '` COMMENT ''' || replace(replace(trim(cc), '\\', '\\\\'), '''', '\\''') || ''';'
FROM bc WHERE cc <> ''"""

SQL["data_dictionary"] = f"""WITH {CAT},
tcs AS (SELECT DB_NAME, TABLE_NAME, arg_min(TABLE_COMMENT, (ORDINAL_POSITION, COLUMN_NAME)) AS tc FROM msspec
        WHERE TABLE_COMMENT IS NOT NULL AND TABLE_COMMENT <> '' GROUP BY DB_NAME, TABLE_NAME)
SELECT s.DB_NAME, s.TABLE_NAME,
       '### ' || s.DB_NAME || '.' || s.TABLE_NAME || CASE WHEN t.tc IS NOT NULL THEN ' / ' || t.tc ELSE '' END AS header,
       t.tc AS table_comment, s.ORDINAL_POSITION AS SEQ, s.COLUMN_NAME AS NAME, s.DATA_TYPE AS TYPE,
       CASE WHEN s.PK = 'YES' THEN 'V' WHEN s.PK = 'NO' THEN '' ELSE s.PK END AS PK, s.COLUMN_COMMENT AS COMMENT
FROM msspec s LEFT JOIN tcs t ON s.DB_NAME = t.DB_NAME AND s.TABLE_NAME = t.TABLE_NAME"""

SQL["rules_tidy"] = """
SELECT 'db' || CAST(o_custkey % 25 AS VARCHAR) || '-T' || CAST(o_orderkey AS VARCHAR) || '.json' AS file_name,
       'selection' AS rule_type,
       CASE WHEN o_orderkey % 5 = 0 THEN 'exclude' ELSE 'include' END AS action,
       CASE WHEN o_orderkey % 13 = 0 THEN 'dbo' ELSE 'db' || CAST(o_custkey % 25 AS VARCHAR) END AS schema,
       'T' || CAST(o_orderkey AS VARCHAR) AS "table"
FROM orders WHERE o_orderkey % 17 <> 0
"""

SQL["tasks_tidy"] = """
SELECT 'task-' || db AS replication_task_identifier, 'arn:aws:dms:region:0:task:' || db AS replication_task_arn,
       'arn:aws:dms:region:0:endpoint:src-' || db AS source_endpoint_arn,
       'arn:aws:dms:region:0:endpoint:lake' AS target_endpoint_arn,
       CASE WHEN length(db) = 3 THEN 'full-load-and-cdc' ELSE 'cdc' END AS migration_type,
       '{"rules":[{"rule-type":"selection","object-locator":{"schema-name":"' || db || '"}}]}' AS table_mappings
FROM (SELECT DISTINCT 'db' || CAST(o_custkey % 25 AS VARCHAR) AS db FROM orders)
"""


def _plan_sql(engine: str) -> str:
    mid = ".dbo.T" if engine == "mssql" else ".T"
    schema = "'dbo'" if engine == "mssql" else "database"
    lists = f"""
lst AS (
  SELECT 'db' || CAST(o_custkey % 25 AS VARCHAR) AS database, 'T' || CAST(o_orderkey AS VARCHAR) AS tbl,
         o_orderkey % 5 = 0 AS excluded, o_orderkey % 2 = 0 AS lower_case, o_orderkey % 3 = 0 AS drop_cols
  FROM orders
  UNION ALL SELECT 'dbx', 'T1', true, false, false
),
slots AS (
  SELECT database, tbl, 0 AS kind, CAST(NULL AS VARCHAR) AS col, excluded AS gap FROM lst
  {"WHERE NOT excluded" if engine == "mssql" else ""}
  {"UNION ALL SELECT database, tbl, 1, NULL, false FROM lst WHERE NOT excluded" if engine == "mssql" else ""}
  UNION ALL SELECT database, tbl, 2, NULL, false FROM lst WHERE NOT excluded AND lower_case
  UNION ALL SELECT database, tbl, 3, 'c1', false FROM lst WHERE NOT excluded AND drop_cols
  UNION ALL SELECT database, tbl, 3, 'c2', false FROM lst WHERE NOT excluded AND drop_cols
  {"UNION ALL SELECT DISTINCT database, NULL, 9, NULL, false FROM lst" if engine == "mssql" else ""}
),
numbered AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY database ORDER BY kind = 9, tbl, kind, col) AS INTEGER) AS rule_id
  FROM slots
)"""
    return f"""
WITH {lists}
SELECT database, rule_id,
       CASE kind WHEN 0 THEN 'include_table_' || rule_id WHEN 1 THEN 'add_column_cdc_dt_' || rule_id
                 WHEN 2 THEN 'table_rename_lower_case_' || rule_id WHEN 3 THEN 'remove_column_' || col || '_' || rule_id
                 ELSE 'schema_rename_dbo_to_' || database END AS rule_name,
       CASE WHEN kind = 0 THEN 'selection' ELSE 'transformation' END AS rule_type,
       CASE kind WHEN 0 THEN 'include' WHEN 1 THEN 'add-column' WHEN 2 THEN 'convert-lowercase'
                 WHEN 3 THEN 'remove-column' ELSE 'rename' END AS rule_action,
       CASE kind WHEN 1 THEN 'column' WHEN 2 THEN 'table' WHEN 3 THEN 'column' WHEN 9 THEN 'schema' END AS rule_target,
       {schema} AS schema_name, tbl AS table_name, col AS column_name,
       CASE kind WHEN 1 THEN 'cdc_dt' WHEN 9 THEN database END AS value,
       CASE WHEN kind = 1 THEN '$AR_H_COMMIT_TIMESTAMP' END AS expression,
       CASE WHEN kind = 1 THEN 'datetime' END AS data_type,
       CAST(CASE WHEN kind = 1 THEN 6 END AS INTEGER) AS "precision"
FROM numbered WHERE NOT gap
"""


SQL["ingest_plan_mssql"] = _plan_sql("mssql")
SQL["ingest_plan_mysql"] = _plan_sql("mysql")

SQL["ingest_plan_documents"] = f"""
SELECT database, count(*) AS n_rules, count(*) FILTER (rule_type = 'selection') AS n_selections,
       count(*) FILTER (rule_type = 'selection') AS n_filter_lists, true AS in_order,
       (count(*) + 199) // 200 AS n_documents, least(count(*), 200) AS most_rules
FROM ({SQL["ingest_plan_mssql"]}) GROUP BY database
"""

SQL["table_selection"] = """
SELECT DISTINCT 'db' || CAST(o_custkey % 25 AS VARCHAR) || '.dbo.T' || CAST(o_orderkey AS VARCHAR) AS name
FROM orders WHERE o_orderkey % 5 <> 0
"""

SQL["apply_ingest_plan"] = f"""
WITH {CHANGE_LOG}
SELECT db AS target_schema,
       CASE WHEN db || '.' || upper(tbl) IN ('store.TB_CLICK', 'store.TB_VIEW', 'billing.TB_PURCHASE') THEN lower(tbl)
            ELSE upper(tbl) END AS target_table,
       "offset", user_id, event_id, event_type,
       CASE WHEN db = 'billing' AND tbl = 'tb_click' THEN NULL ELSE value END AS value,
       CASE WHEN db = 'store' AND tbl = 'tb_view' THEN NULL ELSE props END AS props,
       src_ms AS cdc_dt_ms
FROM cl WHERE NOT (db = 'billing' AND tbl = 'tb_error')
"""

# --- sources, sinks, framing ---------------------------------------------------------

SQL["kafka_json_source"] = f"""
WITH {CHANGE_LOG}
SELECT topic, "partition", "offset", op, user_id, src_ms AS source_ts_ms FROM cl
"""
SQL["connect_json_decode"] = SQL["kafka_json_source"]

SQL["confluent_frame_decode"] = f"""
WITH {CHANGE_LOG}
SELECT topic, "partition", "offset", "offset" % 7 <> 0 AS has_frame,
       CASE WHEN "offset" % 7 <> 0 THEN 7 END AS schema_id
FROM cl
"""

SQL["confluent_jsonschema_decode"] = f"""
WITH {CHANGE_LOG}
SELECT topic, "partition", "offset", CASE WHEN "offset" % 7 <> 0 THEN 7 END AS schema_id, op, ts_ms FROM cl
"""

_SMALL_JSON = """'{"user_id":' || user_id || ',"event_id":' || event_id || ',"event_type":"' || event_type || '"}'"""

SQL["kafka_json_sink"] = f"SELECT CAST(user_id AS VARCHAR) AS key, {_SMALL_JSON} AS value FROM events"
SQL["confluent_jsonschema_encode"] = f"SELECT '0000000007' || hex({_SMALL_JSON}) AS value_hex FROM events"

_GSR_HEX = "0300" + "0f8fad5bd9cb469fa16570867728950e".upper()
SQL["gsr_jsonschema_encode"] = f"SELECT event_id, '{_GSR_HEX}' || hex({_SMALL_JSON}) AS value_hex FROM events"
SQL["gsr_frame_decode"] = """
SELECT event_id, true AS has_frame, 0 AS compression, '0f8fad5b-d9cb-469f-a165-70867728950e' AS schema_version
FROM events
"""
SQL["gsr_jsonschema_decode"] = """
SELECT event_id AS "offset", '0f8fad5b-d9cb-469f-a165-70867728950e' AS schema_version, user_id, event_type FROM events
"""

# the envelope of a created or read row starts with its new image, the others with the old one
SQL["json_archive_sink"] = f"""
WITH {CHANGE_LOG}
SELECT topic, "partition", "offset", CASE WHEN "offset" % 19 <> 0 THEN op END AS op, "offset" % 19 <> 0 AS is_text,
       CASE WHEN "offset" % 19 = 0 THEN 'FF'
            ELSE hex(substr('{{"' || CASE WHEN op IN ('u', 'd') THEN 'before' ELSE 'after' END || '":{{"user_id":' || user_id || ',"event_id"', 21, 1)) END AS byte_21
FROM cl
"""

SQL["connect_json_dead_letters"] = f"""
WITH {CHANGE_LOG}
SELECT topic, "partition", "offset", CASE WHEN "offset" % 19 = 0 THEN 'not UTF-8' ELSE 'undecodable body' END AS error
FROM cl WHERE "offset" % 19 = 0 OR "offset" % 23 = 0
"""

_KST = "epoch_ms(ts_ms) + INTERVAL 9 HOUR"
SQL["lake_daily_sink"] = f"""
WITH {CHANGE_LOG}
SELECT topic, strftime({_KST}, '%Y') AS year, strftime({_KST}, '%m') AS month, strftime({_KST}, '%d') AS day,
       "offset" * 2 AS "offset", op, ts_ms, event_id AS pos, user_id
FROM cl
"""

SQL["lake_compact"] = f"""
WITH {CHANGE_LOG}
SELECT topic, strftime({_KST}, '%Y') AS year, strftime({_KST}, '%m') AS month, strftime({_KST}, '%d') AS day,
       count(*) AS n_rows, CAST(sum("offset" * 2) AS BIGINT) AS sum_offset, CAST(1 AS BIGINT) AS n_files
FROM cl GROUP BY ALL
"""

SQL["lake_compact_by_size"] = SQL["lake_compact"].replace("AS n_files", "AS n_files, CAST(0 AS BIGINT) AS n_again")

SQL["lake_table_scan"] = f"""
WITH {CHANGE_LOG}
SELECT topic, "offset" * 2 AS "offset", op, strftime({_KST}, '%Y') AS year, strftime({_KST}, '%m') AS month,
       strftime({_KST}, '%d') AS day
FROM cl WHERE strftime({_KST}, '%Y%m%d') BETWEEN '20240110' AND '20240120'
"""

SQL["schema_evolution_scan"] = f"""
WITH {LAKE_ROWS}
SELECT lr.id, lr.boolean1 <> 0 AS boolean1, lr.decimal1, CASE WHEN lr.id % 2 = 1 THEN o.o_orderpriority END AS text1
FROM lr JOIN orders o ON lr.id = o.o_orderkey
"""

SQL["schema_versions_found"] = f"""
WITH {LAKE_ROWS}
SELECT lr.id, o_orderstatus AS varchar36, CASE lr.id % 3 WHEN 2 THEN NULL ELSE lr.boolean1 <> 0 END AS boolean1, o_orderkey AS integer2,
       CASE lr.id % 3 WHEN 0 THEN CAST(lr.decimal1 AS DECIMAL(20,8)) WHEN 1 THEN CAST(CAST(lr.decimal1 AS DECIMAL(16,4)) AS DECIMAL(20,8))
                      ELSE CAST(lr.id AS DECIMAL(20,8)) END AS decimal1,
       CASE lr.id % 3 WHEN 0 THEN CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) WHEN 1 THEN o_totalprice ELSE CAST(lr.id AS DOUBLE) END AS float1,
       CASE lr.id % 3 WHEN 1 THEN o_orderpriority WHEN 2 THEN CAST(lr.id AS VARCHAR) END AS text1,
       CASE WHEN lr.id % 3 < 2 THEN CAST(lr.id AS BIGINT) END AS image_key, CASE WHEN lr.id % 3 < 2 THEN lr.date1 END AS image_date1,
       CASE WHEN lr.id % 3 = 1 THEN o_orderpriority END AS image_text1
FROM lr JOIN orders o ON lr.id = o.o_orderkey
"""

SQL["schema_versions"] = """
SELECT CASE o_orderkey % 3 WHEN 0 THEN 'id,boolean1,integer2,decimal1,float1,image'
                           WHEN 1 THEN 'id,boolean1,integer2,decimal1,float1,text1,image'
                           ELSE 'integer2,id,text1,float1,decimal1' END AS columns, count(*) AS n_rows
FROM orders GROUP BY 1
"""

_BLANK = lambda c: f"CASE WHEN trim({c}) <> '' THEN {c} END AS {c}"
_SPEC_TEXT_COLS = ["TABLE_COMMENT", "COLUMN_NAME", "COLUMN_TYPE", "CHARACTER_SET", "COLLATION_NAME", "DATA_TYPE",
                   "COLUMN_LENGTH", "COLUMN_DEFAULT", "IS_NULLABLE", "IS_UNIQUE", "IS_AUTO_INCREMENT", "COLUMN_EXTRA",
                   "PK", "COLUMN_COMMENT"]
SQL["spec_snapshot_io"] = f"""
WITH {CAT},
saved AS MATERIALIZED (SELECT * FROM myspec)
SELECT DB_NAME, TABLE_NAME, ORDINAL_POSITION, {', '.join(_BLANK(c) for c in _SPEC_TEXT_COLS)},
       strftime(CREATE_TIME, '%Y-%m-%d %H:%M:%S') AS CREATE_TIME, strftime(UPDATE_TIME, '%Y-%m-%d %H:%M:%S') AS UPDATE_TIME,
       "ROW"
FROM saved ORDER BY DB_NAME, TABLE_NAME, ORDINAL_POSITION
"""

# damaged records: offsets are doubled there (tombstones take the odd ones)
SQL["dead_letter_split"] = f"""
WITH {CHANGE_LOG}, rec AS (SELECT topic, "partition", "offset" * 2 AS "offset" FROM cl)
SELECT topic, "partition", "offset",
       CASE WHEN "offset" % 7 = 0 THEN 'missing magic byte' WHEN "offset" % 26 = 0 THEN 'cut header'
            WHEN "offset" % 22 = 0 THEN 'undecodable body' ELSE 'not UTF-8' END AS error
FROM rec WHERE "offset" % 7 = 0 OR "offset" % 26 = 0 OR "offset" % 22 = 0 OR "offset" % 38 = 0
"""

SQL["capture_accounting"] = f"""
WITH {CHANGE_LOG}, rec AS (
  SELECT topic, op, "offset" * 2 % 26 = 0 OR "offset" * 2 % 22 = 0 OR "offset" * 2 % 38 = 0 AS damaged FROM cl
)
SELECT topic, count(*) + count(*) FILTER (op = 'd') AS n_records, count(*) FILTER (NOT damaged) AS n_lake,
       count(*) FILTER (damaged) AS n_dead, count(*) FILTER (op = 'd') AS n_tombstones, CAST(0 AS BIGINT) AS n_lost,
       CAST(0 AS BIGINT) AS n_repeated, CAST(0 AS BIGINT) AS n_stray
FROM rec GROUP BY topic
"""

SQL["replayed_capture"] = f"""
WITH {CHANGE_LOG}, rec AS (
  SELECT topic, "offset" * 2 AS o, false AS tomb FROM cl
  UNION ALL
  SELECT topic, "offset" * 2 + 1, true FROM cl WHERE op = 'd'
), copies AS (
  SELECT topic, tomb, NOT tomb AND (o % 26 = 0 OR o % 22 = 0 OR o % 38 = 0) AS damaged,
         1 + CASE WHEN o // 40 % 9 = 4 THEN 1 + CAST(o // 40 % 5 = 0 AS INT) ELSE 0 END AS n
  FROM rec
)
SELECT topic, CAST(sum(n) AS BIGINT) AS n_records, count(*) FILTER (NOT damaged AND NOT tomb) AS n_lake,
       count(*) FILTER (damaged) AS n_dead, count(*) FILTER (tomb) AS n_tombstones, CAST(0 AS BIGINT) AS n_lost,
       CAST(0 AS BIGINT) AS n_repeated, CAST(0 AS BIGINT) AS n_stray
FROM copies GROUP BY topic
"""

SQL["offset_gaps"] = """
WITH full_log AS (
  SELECT CAST(CASE WHEN event_id % 16 >= 4 THEN 0 ELSE event_id % 16 + 1 END AS INT) AS p,
         CASE WHEN event_id % 16 >= 4 THEN event_id // 16 * 12 + event_id % 16 - 4 ELSE event_id // 16 END AS o
  FROM events
), kept AS (
  SELECT p, o, 1 + CAST(o // 7 % 10 = 3 AS INT) + CAST(o % 210 = 22 AS INT) AS n FROM full_log WHERE o % 900 <> 77 AND o // 11 % 13 <> 5
), expected AS (
  SELECT p, unnest(range(-10, n + 10)) AS o FROM (SELECT p, count(*) AS n FROM full_log GROUP BY p)
), marked AS (
  SELECT p, o, 'missing' AS kind, 1 AS n FROM expected ANTI JOIN kept USING (p, o)
  UNION ALL
  SELECT p, o, 'repeated', n - 1 FROM kept WHERE n > 1
), grouped AS (
  SELECT *, o - row_number() OVER (PARTITION BY p, kind ORDER BY o) AS island FROM marked
)
SELECT 'local.store.journal' AS topic, p AS "partition", kind, CAST(min(o) AS BIGINT) AS first_offset, CAST(max(o) AS BIGINT) AS last_offset,
       CAST(sum(n) AS BIGINT) AS n_records
FROM grouped GROUP BY p, kind, island
"""

SQL["confluent_jsonschema_decode_versions"] = """
SELECT event_id AS "offset", CAST(CASE event_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 9 END AS INT) AS schema_id,
       CASE WHEN event_id % 3 < 2 THEN user_id END AS user_id, CASE WHEN event_id % 3 = 1 THEN event_type END AS event_type
FROM events
"""

SQL["gsr_zlib_decode"] = """
SELECT event_id AS "offset", CASE WHEN event_id % 5 <> 0 THEN user_id END AS user_id,
       CASE WHEN event_id % 5 = 0 THEN 'compressed body' END AS error
FROM events
"""

SQL["bronze_head"] = SQL["bronze_latest_state"] + "\nORDER BY __db_table, id_iceberg LIMIT 10"
SQL["bronze_upsert"] = SQL["bronze_latest_state"]
SQL["bronze_upsert_by_file"] = SQL["bronze_latest_state"]

SQL["lag_by_minute"] = f"""
WITH {CHANGE_LOG}
SELECT db || '_bronze.' || tbl AS __db_table,
       strftime(date_trunc('minute', epoch_ms(src_ms)), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(date_trunc('minute', epoch_ms(src_ms)) + INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end,
       count(*) AS n_events,
       sum((ts_ms - src_ms) * 1000) / count(*) / 1000000::DOUBLE AS avg_latency,
       max((ts_ms - src_ms) * 1000) / 1000000::DOUBLE AS max_latency
FROM cl GROUP BY ALL
"""

_EXTRACT = """
SELECT o_orderkey AS id,
       CASE WHEN o_orderkey % 50 = 0 THEN o_orderkey || ' pcs' WHEN o_orderkey % 70 = 0 THEN '99999999999' ELSE CAST(o_orderkey AS VARCHAR) END AS qty,
       CASE WHEN o_orderkey % 40 = 0 THEN 'n/a' WHEN o_orderkey % 30 = 0 THEN '1.23456' ELSE o_orderkey % 1000 || '.5' END AS price,
       CASE o_orderkey % 9 WHEN 0 THEN 'false' WHEN 1 THEN 'maybe' WHEN 2 THEN '0' ELSE '1' END AS active,
       CASE WHEN o_orderkey % 11 = 0 THEN '0000-00-00' WHEN o_orderkey % 13 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS "day"
FROM orders"""

SQL["cast_misfits"] = f"""
WITH e AS ({_EXTRACT})
SELECT id, 'qty' AS column_name, 'int' AS spark_type, qty AS value FROM e WHERE TRY_CAST(qty AS INT) IS NULL
UNION ALL SELECT id, 'price', 'decimal(8,2)', price FROM e WHERE price = 'n/a'
UNION ALL SELECT id, 'active', 'boolean', active FROM e WHERE active = 'maybe'
UNION ALL SELECT id, 'day', 'date', "day" FROM e WHERE "day" = '0000-00-00'
"""

SQL["type_fit_report"] = f"""
WITH e AS ({_EXTRACT}), m AS (
  SELECT 'qty' AS c, count(qty) AS n, count(*) FILTER (TRY_CAST(qty AS INT) IS NULL) AS bad,
         min(qty) FILTER (TRY_CAST(qty AS INT) IS NULL) AS x, 0 AS r, NULL AS y FROM e
  UNION ALL SELECT 'price', count(price), count(*) FILTER (price = 'n/a'), min(price) FILTER (price = 'n/a'),
         count(*) FILTER (price = '1.23456'), min(price) FILTER (price = '1.23456') FROM e
  UNION ALL SELECT 'active', count(active), count(*) FILTER (active = 'maybe'), min(active) FILTER (active = 'maybe'), 0, NULL FROM e
  UNION ALL SELECT 'flag', count(*), 0, NULL, 0, NULL FROM e
  UNION ALL SELECT 'day', count("day"), count(*) FILTER ("day" = '0000-00-00'), min("day") FILTER ("day" = '0000-00-00'), 0, NULL FROM e
)
SELECT c AS column_name, CASE c WHEN 'flag' THEN 'binary' ELSE 'string' END AS source_type,
       CASE c WHEN 'qty' THEN 'int' WHEN 'price' THEN 'decimal(8,2)' WHEN 'day' THEN 'date' ELSE 'boolean' END AS spark_type,
       n AS n_values, bad AS n_misfits, x AS smallest_misfit, CAST(r AS BIGINT) AS n_rounded, y AS smallest_rounded
FROM m
"""

SQL["wildcard_selection"] = """
WITH names AS (
  SELECT DISTINCT 'db' || CAST(o_custkey % 25 AS VARCHAR) AS s, 'T' || CAST(o_orderkey AS VARCHAR) AS t FROM orders
  UNION ALL SELECT 'dbx', 'T1'
), rules AS (
  SELECT DISTINCT * FROM (
    SELECT 'include' AS action, 'db' || o_custkey % 25 AS sp, 'T' || o_orderkey // 100 || '%' AS tp FROM orders WHERE o_orderkey % 97 = 0
    UNION ALL SELECT 'include', 'db' || (o_custkey % 25) // 10 || '%', '%' || o_orderkey % 1000 FROM orders WHERE o_orderkey % 101 = 0
    UNION ALL SELECT 'exclude', '%', '%' || o_orderkey % 1000 FROM orders WHERE o_orderkey % 89 = 0
    UNION ALL VALUES ('include', 'db7', '%'), ('exclude', 'db1$_', 'T%'), ('include', 'db12', 'T5'), ('exclude', 'db7', '%99'))
), met AS (
  SELECT s, t, bool_or(action = 'include') AS inn, bool_or(action = 'exclude') AS outt
  FROM names JOIN rules ON s LIKE sp ESCAPE '$' AND t LIKE tp ESCAPE '$' GROUP BY s, t
)
SELECT s AS schema, t AS "table" FROM met WHERE inn AND NOT outt
"""

SQL["late_by_minute"] = f"""
WITH {CHANGE_LOG}, r AS (
  SELECT db || '_bronze.' || tbl AS __db_table, src_ms, src_ms // 60000 AS minute, src_ms + "offset" % 50 * 60000 + "offset" % 1000 AS arrived FROM cl
), marks AS (
  SELECT b, max(newest) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 600000 AS mark
  FROM (SELECT arrived // 60000 AS b, max(src_ms) AS newest FROM r GROUP BY 1)
)
SELECT __db_table, strftime(epoch_ms(minute * 60000), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n_late,
       max(arrived - (minute + 1) * 60000) * 1000 / 1000000::DOUBLE AS max_behind
FROM r JOIN marks ON arrived // 60000 = b WHERE (minute + 1) * 60000 <= mark GROUP BY __db_table, minute
"""

SQL["rules_json_scan"] = """
WITH lst AS (
  SELECT 'db' || CAST(o_custkey % 25 AS VARCHAR) AS database, 'T' || CAST(o_orderkey AS VARCHAR) AS tbl,
         o_orderkey % 5 = 0 AS excluded
  FROM orders
)
SELECT database AS file_name, 'selection' AS rule_type, 'include' AS action, database AS schema, tbl AS "table"
FROM lst WHERE NOT excluded
"""

# fixed values: the words Spark SQL reserves in ANSI mode, as its documentation lists them
SPARK_RESERVED = (
    "ALL AND ANY AS AUTHORIZATION BOTH CALL CASE CAST CHECK COLLATE COLLATION COLUMN CONSTRAINT CREATE CROSS CURRENT_DATE "
    "CURRENT_TIME CURRENT_TIMESTAMP CURRENT_USER DISTINCT ELSE END ESCAPE EXCEPT EXECUTE FALSE FETCH FILTER FOR FOREIGN "
    "FROM FULL GRANT GROUP HAVING IN INNER INTERSECT INTO IS JOIN LATERAL LEADING LEFT NATURAL NOT NULL OFFSET ON ONLY OR "
    "ORDER OUTER OVERLAPS PRIMARY RECURSIVE REFERENCES RIGHT SELECT SESSION_USER SOME SQL TABLE THEN TIME TO TRAILING "
    "UNION UNIQUE UNKNOWN USER USING WHEN WHERE WITH WITHIN")
SQL["naming_audit"] = f"""
WITH {CAT},
words AS (SELECT unnest(string_split('{SPARK_RESERVED}', ' ')) AS w),
names AS (
  SELECT DB_NAME, 'column' AS kind, TABLE_NAME, COLUMN_NAME AS name FROM msspec
  UNION ALL
  SELECT DISTINCT DB_NAME, 'table', TABLE_NAME, TABLE_NAME FROM msspec
),
flagged AS (
  SELECT n.*, w.w IS NOT NULL AS reserved,
         regexp_matches(trim(n.name), '[가-힣()\\[\\]#~ ]') OR regexp_full_match(trim(n.name), '[0-9]+') AS special
  FROM names n LEFT JOIN words w ON upper(trim(n.name)) = w.w
)
SELECT DB_NAME, kind, TABLE_NAME, name, reserved, special FROM flagged WHERE reserved OR special
"""
