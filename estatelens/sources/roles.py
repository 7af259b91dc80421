"""Catalog roles projected from the driver tables.

The driver's tables hold no catalog metadata, so each catalog role
(data files, extents, segments, users, grants ...) is a deterministic SQL
projection of all their rows. The same text is a Spark SQL view here and a CTE in
the DuckDB oracle, so both engines see identical role rows.

Every role scans a driver table that grows with the scale factor; roles
that are one row per database are GROUP BYs over such a table, never a
fixed literal. Fleet key: ``db_name``. Owner of key k is U(k%50) in
DB(k%50%4); the table of key k is T_(k%150).

Fixed values: as_of for the ``events`` derived roles is 2024-01-31 00:00:00,
for the ``orders`` derived roles 2001-08-02 00:00:00.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()

EVENTS_AS_OF = "2024-01-31 00:00:00"
ORDERS_AS_OF = "2001-08-02 00:00:00"

ROLE_SQL: dict[str, str] = {}


def _role(name: str, sql: str) -> None:
    ROLE_SQL[name] = " ".join(sql.split())


# ---------------------------------------------------------------- storage
_role("data_files", """
SELECT concat('DB', s_suppkey % 4) AS db_name, s_suppkey AS file_id,
  concat('/u0', s_suppkey % 5, '/', s_name) AS file_name, CASE s_suppkey % 10 WHEN 8 THEN 'SYSAUX' WHEN 9 THEN 'UNDOTBS1' ELSE concat('TS_', s_suppkey % 10) END AS tablespace_name,
  CAST((s_suppkey % 7 + 1) * 1048576 * 50 AS BIGINT) AS bytes,
  CASE WHEN s_suppkey % 3 = 0 THEN CAST(34359721984 AS BIGINT) ELSE CAST((s_suppkey % 7 + 1) * 1048576 * 200 AS BIGINT) END AS maxbytes,
  CAST((s_suppkey % 7 + 1) * 6400 AS BIGINT) AS blocks,
  CASE WHEN s_acctbal < 0 THEN 'NO' ELSE 'YES' END AS autoextensible, CAST((s_suppkey % 4) * 640 AS BIGINT) AS increment_by
FROM supplier""")

_role("temp_files", """
SELECT concat('DB', s_suppkey % 4) AS db_name, concat('TEMP_', s_suppkey % 3) AS tablespace_name,
  concat('/u0', s_suppkey % 5, '/temp_', s_suppkey, '.dbf') AS file_name,
  CAST((s_suppkey % 5 + 1) * 1048576 * 100 AS BIGINT) AS bytes,
  CAST((s_suppkey % 5 + 1) * 1048576 * 400 AS BIGINT) AS maxbytes,
  CASE WHEN s_suppkey % 2 = 0 THEN 'YES' ELSE 'NO' END AS autoextensible, CAST(1280 AS BIGINT) AS increment_by
FROM supplier""")

_role("extents", """
SELECT concat('DB', k % 4) AS db_name, k AS file_id,
  (l_orderkey * 37) % (CASE WHEN k % 2 = 0 THEN 6400 * (k % 7 + 1) - 50 ELSE 3000 END) AS block_id,
  CAST(l_quantity AS BIGINT) AS blocks, CAST(l_quantity AS BIGINT) * 8192 AS bytes,
  CASE k % 10 WHEN 8 THEN 'SYSAUX' WHEN 9 THEN 'UNDOTBS1' ELSE concat('TS_', k % 10) END AS tablespace_name
FROM (SELECT l_orderkey, l_quantity, CASE WHEN l_suppkey % 11 = 10 THEN l_suppkey - 1 ELSE l_suppkey END AS k FROM lineitem) t""")

_role("segments", """
SELECT concat('DB', p_partkey % 150 % 50 % 4) AS db_name, concat('U', p_partkey % 150 % 50) AS owner,
  CASE p_partkey % 3 WHEN 0 THEN concat('T_', p_partkey % 150) WHEN 1 THEN concat('IX_', p_partkey) ELSE concat('LOB_', p_partkey) END AS segment_name,
  CASE p_partkey % 3 WHEN 0 THEN 'TABLE' WHEN 1 THEN 'INDEX' ELSE 'LOBSEGMENT' END AS segment_type,
  CASE WHEN p_size = 1 THEN 'SYSTEM' ELSE concat('TS_', p_partkey % 8) END AS tablespace_name,
  CAST(p_size AS BIGINT) * 1048576 AS bytes
FROM part""")

_role("lobs", """
SELECT concat('DB', k % 150 % 50 % 4) AS db_name, concat('U', k % 150 % 50) AS owner,
  concat('T_', k % 150) AS table_name, concat('C', p_size % 5) AS column_name, concat('LOB_', k) AS segment_name
FROM (SELECT p_size, p_partkey * 3 + 2 AS k FROM part) t""")

_role("recyclebin", """
SELECT concat('DB', CASE o_orderkey % 4 WHEN 2 THEN 0 ELSE o_orderkey % 4 END) AS db_name, concat('BIN$', o_orderkey) AS object_name,
  CAST(o_orderkey % 64 + 8 AS BIGINT) AS space
FROM orders""")

_role("tablespaces", """
SELECT DISTINCT concat('DB', p_partkey % 150 % 50 % 4) AS db_name,
  CASE WHEN p_size = 1 THEN 'SYSTEM' ELSE concat('TS_', p_partkey % 8) END AS tablespace_name,
  CASE WHEN p_partkey % 8 = 7 AND p_size <> 1 THEN 'TEMPORARY' ELSE 'PERMANENT' END AS contents,
  CAST(8192 AS BIGINT) AS block_size, CAST(65536 AS BIGINT) AS initial_extent, 'LOCAL' AS extent_management, 'SYSTEM' AS allocation_type,
  CASE WHEN p_size = 1 THEN 'MANUAL' ELSE 'AUTO' END AS segment_space_management,
  CASE WHEN p_partkey % 8 > 3 AND p_size <> 1 THEN 'YES' ELSE 'NO' END AS bigfile
FROM part
UNION
SELECT DISTINCT concat('DB', c_custkey % 2), 'APP_200108', 'PERMANENT', CAST(8192 AS BIGINT), CAST(65536 AS BIGINT), 'LOCAL', 'SYSTEM', 'AUTO', 'YES'
FROM customer""")

_role("ts_groups", """
SELECT DISTINCT concat('DB', s_suppkey % 4) AS db_name, 'TEMP_GRP' AS group_name, concat('TEMP_', s_suppkey % 3) AS tablespace_name
FROM supplier""")

_role("sort_usage", """
SELECT concat('DB', user_id % 4) AS db_name, CASE WHEN user_id % 3 = 0 THEN 'TEMP_0' ELSE 'TEMP_1' END AS tablespace,
  CAST(round(value) AS BIGINT) AS blocks
FROM events WHERE event_type = 'view'""")

_role("redo", """
SELECT concat('DB', s_suppkey % 4) AS db_name, CAST(s_suppkey % 2 + 1 AS BIGINT) AS thread, s_suppkey AS group_no,
  CAST((s_suppkey % 3 + 1) * 1048576 * 512 AS BIGINT) AS bytes, CAST(s_suppkey % 2 + 1 AS BIGINT) AS members,
  concat('/redo/', s_name, '.log') AS member
FROM supplier""")

_role("standby_redo", """
SELECT concat('DB', s_suppkey % 4) AS db_name, CAST(s_suppkey % 2 + 1 AS BIGINT) AS thread, s_suppkey AS group_no,
  CAST((s_suppkey % 3 + 1) * 1048576 * 512 AS BIGINT) AS bytes, concat('/redo/sb_', s_name, '.log') AS member
FROM supplier""")

# ------------------------------------------------------- recovery / redo
_role("recovery_dest", """
SELECT concat('DB', c_custkey % 4) AS db_name, CAST(53687091200 AS BIGINT) AS space_limit,
  CAST((c_custkey % 4 + 1) * 10737418240 AS BIGINT) AS space_used,
  CAST((c_custkey % 4) * 2147483648 AS BIGINT) AS space_reclaimable
FROM customer GROUP BY c_custkey % 4""")

_role("recovery_usage", """
SELECT concat('DB', c_custkey % 25 % 4) AS db_name, concat('TYPE_', c_custkey % 25) AS file_type,
  CAST(c_custkey % 25 % 7 AS DOUBLE) * 1.5 AS percent_space_used, CAST(c_custkey % 25 % 3 AS DOUBLE) AS percent_space_reclaimable
FROM customer GROUP BY c_custkey % 25""")

_role("archived_log", """
SELECT concat('DB', user_id % 4) AS db_name, event_id AS recid, ts AS completion_time,
  CAST(round(value * 100) AS BIGINT) AS blocks, CAST(512 AS BIGINT) AS block_size,
  CASE WHEN event_type = 'error' THEN 'YES' ELSE 'NO' END AS deleted,
  CASE WHEN user_id % 10 = 0 THEN 'NO' ELSE 'YES' END AS is_recovery_dest_file
FROM events""")

_role("sysstat", """
SELECT concat('DB', user_id % 4) AS db_name, event_id AS snap_id, CAST(user_id % 8 >= 4 AS INT) + 1 AS instance_number,
  ts AS begin_interval_time, 'redo size' AS stat_name,
  CAST((day(ts) * 24 + hour(ts)) * 60 + minute(ts) AS BIGINT) * (1 + user_id % 4) * 1048576 AS value
FROM events""")

# ---------------------------------------------------------- databases
_role("databases", """
SELECT concat('DB', c_custkey % 4) AS db_name, CAST(c_custkey % 4 AS BIGINT) AS dbid,
  concat('DB', c_custkey % 4) AS name,
  CASE c_custkey % 4 WHEN 0 THEN 'NO' WHEN 2 THEN 'YES' ELSE 'RESTORE POINT ONLY' END AS flashback_on,
  CASE c_custkey % 4 WHEN 3 THEN 'PHYSICAL STANDBY' ELSE 'PRIMARY' END AS database_role,
  CASE c_custkey % 4 WHEN 3 THEN 'MOUNTED' ELSE 'READ WRITE' END AS open_mode,
  CASE c_custkey % 4 WHEN 1 THEN 'NOARCHIVELOG' ELSE 'ARCHIVELOG' END AS log_mode,
  concat('DB', c_custkey % 4, '_SITE') AS db_unique_name, CASE c_custkey % 4 WHEN 3 THEN 'DB3_MAIN' ELSE NULL END AS primary_db_unique_name,
  TIMESTAMP '2000-01-01 00:00:00' + INTERVAL 1 DAY * (c_custkey % 4) AS created,
  min(c_name) AS platform_name
FROM customer GROUP BY c_custkey % 4""")

_role("instance", """
SELECT concat('DB', c_custkey % 4) AS db_name, concat('19.', c_custkey % 4 + 18, '.0.0.0') AS version,
  concat('host', c_custkey % 4 % 2) AS host_name, concat('db', c_custkey % 4, '_1') AS instance_name
FROM customer GROUP BY c_custkey % 4""")

_role("parameters", """
SELECT concat('DB', k4) AS db_name,
  CASE q WHEN 0 THEN 'cpu_count' WHEN 1 THEN 'clonedb' WHEN 2 THEN 'db_block_size' WHEN 3 THEN 'log_archive_dest_1'
    WHEN 4 THEN 'db_recovery_file_dest_size' WHEN 5 THEN 'db_unique_name' WHEN 6 THEN 'fal_server' ELSE 'log_archive_dest_state_2' END AS name,
  CASE q WHEN 0 THEN '16' WHEN 1 THEN CASE WHEN k4 = 0 THEN 'TRUE' ELSE 'FALSE' END WHEN 2 THEN '8192' WHEN 3 THEN 'LOCATION=/arch'
    WHEN 4 THEN '53687091200' WHEN 5 THEN concat('DB', k4, '_SITE') WHEN 6 THEN CASE WHEN k4 = 3 THEN NULL ELSE concat('DB', k4, '_STBY') END
    ELSE CASE WHEN k4 = 1 THEN 'DEFER' ELSE 'enable' END END AS value
FROM (SELECT c_custkey % 4 AS k4, CAST((c_custkey % 32 - c_custkey % 4) / 4 AS INT) AS q FROM customer) t
GROUP BY k4, q""")

_role("restore_points", """
SELECT concat('DB', CASE o_orderkey % 4 WHEN 3 THEN 1 ELSE o_orderkey % 4 END) AS db_name, concat('RP_', o_orderkey) AS name, o_orderdate AS time,
  CASE WHEN o_orderkey % 3 = 0 THEN 'YES' ELSE 'NO' END AS guarantee_flashback_database
FROM orders""")

_role("containers", """
SELECT concat('DB', g % 4) AS db_name, CAST(q + 1 AS BIGINT) AS con_id,
  CASE q WHEN 0 THEN 'CDB$ROOT' WHEN 1 THEN 'PDB$SEED' ELSE concat('PDB', g) END AS name,
  concat('GUID', g) AS guid,
  CASE WHEN q = 1 THEN 'READ ONLY' WHEN g = 19 THEN 'MOUNTED' ELSE 'READ WRITE' END AS open_mode
FROM (SELECT c_custkey % 20 AS g, CAST((c_custkey % 20 - c_custkey % 4) / 4 AS INT) AS q FROM customer) t
GROUP BY g, q""")

_role("saved_states", """
SELECT concat('DB', c_custkey % 20 % 4) AS db_name, concat('PDB', c_custkey % 20) AS con_name, 'OPEN' AS state,
  'READ WRITE' AS restricted_mode_open
FROM customer GROUP BY c_custkey % 20""")

_role("db_properties", """
SELECT concat('DB', c_custkey % 4) AS db_name,
  CASE c_custkey % 3 WHEN 0 THEN 'DEFAULT_TEMP_TABLESPACE' WHEN 1 THEN 'LOCAL_UNDO_ENABLED' ELSE 'DEFAULT_PERMANENT_TABLESPACE' END AS property_name,
  CASE c_custkey % 3 WHEN 0 THEN 'TEMP' WHEN 1 THEN 'TRUE' ELSE 'USERS' END AS property_value
FROM customer GROUP BY c_custkey % 4, c_custkey % 3""")

_role("registry", """
SELECT concat('DB', p_partkey % 4) AS db_name, concat('COMP', p_size % 12) AS comp_id, concat('Component ', p_size % 12) AS comp_name,
  concat('19.', p_size % 3) AS version,
  CASE WHEN p_size % 12 = 5 AND p_partkey % 4 = 2 THEN 'INVALID' WHEN p_size % 12 = 7 THEN 'OPTION OFF' ELSE 'VALID' END AS status
FROM part GROUP BY p_partkey % 4, p_size % 12, p_size % 3""")

_role("registry_history", """
SELECT concat('DB', o_orderkey % 4) AS db_name, o_orderdate AS action_time, 'APPLY' AS action, 'SERVER' AS namespace,
  concat('19.', o_orderkey % 20) AS version, o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'PSU' ELSE NULL END AS bundle_series,
  concat('RU 19.', o_orderkey % 20) AS comments
FROM orders""")

_role("network_acls", """
SELECT concat('DB', o_orderkey % 4) AS db_name, concat('/sys/acls/', o_orderkey, '.xml') AS acl,
  CASE WHEN o_orderkey % 4 = 2 THEN '*' ELSE concat('host', o_custkey) END AS host
FROM orders
UNION ALL
SELECT concat('DB', c_custkey % 4), concat('/sys/acls/default_', c_custkey % 4, '.xml'), CASE c_custkey % 4 WHEN 1 THEN '*' ELSE 'localhost' END
FROM customer GROUP BY c_custkey % 4""")

_role("pgastat", """
SELECT concat('DB', user_id % 4) AS db_name, concat('pga ', event_type) AS name,
  CASE WHEN event_type = 'click' THEN sum(value) ELSE sum(value) * 1048576 END AS value,
  CASE WHEN event_type = 'click' THEN NULL ELSE 'bytes' END AS unit
FROM events GROUP BY user_id % 4, event_type""")

_role("pga_advice", """
SELECT concat('DB', k4) AS db_name, CAST(q + 1 AS BIGINT) * 268435456 AS pga_target_for_estimate,
  CAST(q + 1 AS DOUBLE) * 0.25 AS pga_target_factor,
  CAST(sum(CAST(round(c_acctbal * 1000) AS BIGINT)) + 100000000000 AS BIGINT) AS bytes_processed,
  CAST(max(c_custkey) * 1000 AS BIGINT) AS estd_extra_bytes_rw,
  CAST(q * 12 + 3 AS DOUBLE) AS estd_pga_cache_hit_percentage,
  CAST(CASE WHEN q < 2 THEN 3 ELSE 0 END AS BIGINT) AS estd_overalloc_count
FROM (SELECT c_custkey, c_acctbal, c_custkey % 4 AS k4, CAST((c_custkey % 32 - c_custkey % 4) / 4 AS INT) AS q FROM customer) t
GROUP BY k4, q""")

# --------------------------------------------------------------- tables
_role("tables", """
SELECT concat('DB', c.c_custkey % 50 % 4) AS db_name, concat('U', c.c_custkey % 50) AS owner, concat('T_', c.c_custkey) AS table_name,
  CASE WHEN c.c_acctbal < 0 THEN NULL ELSE CAST(round(c.c_acctbal * 10) AS BIGINT) END AS num_rows,
  CASE WHEN c.c_acctbal < 0 THEN NULL ELSE o.last_order END AS last_analyzed,
  CASE WHEN c.c_custkey % 23 = 0 THEN 'Y' ELSE 'N' END AS temporary, 'N' AS secondary,
  CASE WHEN c.c_custkey % 29 = 0 THEN 'NO' ELSE 'YES' END AS segment_created,
  CASE WHEN c.c_custkey % 5 = 0 THEN 'YES' ELSE 'NO' END AS partitioned,
  CASE WHEN c.c_custkey % 2 = 0 THEN 'ENABLED' ELSE 'DISABLED' END AS row_movement,
  CASE WHEN c.c_custkey % 31 = 0 THEN 'IOT' ELSE NULL END AS iot_type,
  CASE WHEN c.c_custkey % 7 = 0 THEN 'ENABLED' ELSE 'DISABLED' END AS compression,
  CASE WHEN c.c_custkey % 37 = 0 THEN 'YES' ELSE 'NO' END AS read_only,
  CASE WHEN c.c_custkey % 3 = 0 THEN 'DEFAULT' ELSE CAST(c.c_custkey % 12 AS STRING) END AS degree,
  concat('TS_', c.c_custkey % 8) AS tablespace_name
FROM customer c LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last_order FROM orders GROUP BY o_custkey) o ON o.o_custkey = c.c_custkey
UNION ALL
SELECT DISTINCT concat('DB', m % 4), 'APP', concat('TAR_SALES_', m % 3), CAST(NULL AS BIGINT), CAST(NULL AS TIMESTAMP),
  'N', 'N', 'YES', 'YES', 'ENABLED', CAST(NULL AS STRING), 'DISABLED', 'NO', '1', 'TS_0'
FROM (SELECT year(o_orderdate) * 12 + month(o_orderdate) AS m FROM orders) t
UNION ALL
SELECT concat('DB', s_suppkey % 4), CASE s_suppkey % 4 WHEN 0 THEN 'MDSYS' WHEN 1 THEN 'XDB' WHEN 2 THEN 'APEX_040200' ELSE concat('U', s_suppkey % 50) END, concat('SYS_T', s_suppkey), CAST(s_suppkey AS BIGINT), CAST(NULL AS TIMESTAMP),
  'N', 'N', 'YES', 'NO', 'DISABLED', CAST(NULL AS STRING), 'DISABLED', 'NO', '1', 'SYSAUX'
FROM supplier""")

_role("tab_stats", """
SELECT concat('DB', c_custkey % 50 % 4) AS db_name, concat('U', c_custkey % 50) AS owner, concat('T_', c_custkey) AS table_name,
  CAST(NULL AS STRING) AS partition_name,
  CASE WHEN c_custkey % 11 = 0 THEN 'ALL' ELSE NULL END AS stattype_locked
FROM customer
UNION ALL
SELECT DISTINCT concat('DB', m % 4), 'APP', concat('TAR_SALES_', m % 3),
  CASE WHEN m % 2 = 0 THEN concat('SYS_P', m) ELSE concat('SALES_', m) END,
  CASE WHEN m % 7 = 0 THEN 'ALL' ELSE NULL END
FROM (SELECT year(o_orderdate) * 12 + month(o_orderdate) AS m FROM orders) t
UNION ALL
SELECT concat('DB', s_suppkey % 4), CASE s_suppkey % 4 WHEN 0 THEN 'MDSYS' WHEN 1 THEN 'XDB' WHEN 2 THEN 'APEX_040200' ELSE concat('U', s_suppkey % 50) END, concat('SYS_T', s_suppkey), CAST(NULL AS STRING), CAST(NULL AS STRING)
FROM supplier""")

for _r, _m in (("externals", 13), ("mviews", 17), ("mview_logs", 19)):    # names every 13th table and so on, and tables since dropped
    _role(_r, f"""
SELECT concat('DB', k % 50 % 4) AS db_name, concat('U', k % 50) AS owner, concat('T_', k) AS name
FROM (SELECT c_custkey * {_m} AS k FROM customer) t""")

_role("internal_owners", "SELECT DISTINCT concat('U', c_custkey % 5) AS owner FROM customer")

_role("views", """
SELECT concat('DB', o_orderkey % 50 % 4) AS db_name, CASE WHEN o_orderkey % 41 = 0 THEN 'PUBLIC' WHEN o_orderkey % 43 = 0 THEN 'APEX_040200' WHEN o_orderkey % 47 = 0 THEN 'MDSYS' ELSE concat('U', o_orderkey % 50) END AS owner,
  concat('OBJ_', o_orderkey) AS view_name, CAST(o_orderkey % 400 + 20 AS BIGINT) AS text_length
FROM orders WHERE o_orderpriority = '2-HIGH'""")

# -------------------------------------------------------------- indexes
_role("indexes", """
SELECT concat('DB', p_partkey % 150 % 50 % 4) AS db_name,
  CASE WHEN p_size = 50 THEN 'U49' ELSE concat('U', p_partkey % 150 % 50) END AS owner, concat('IX_', p_partkey) AS index_name,
  concat('U', p_partkey % 150 % 50) AS table_owner, concat('T_', p_partkey % 150) AS table_name,
  CASE p_type WHEN 'ECONOMY' THEN 'BITMAP' WHEN 'PROMO' THEN 'FUNCTION-BASED NORMAL' ELSE 'NORMAL' END AS index_type,
  CASE WHEN p_size % 3 = 0 THEN 'UNIQUE' ELSE 'NONUNIQUE' END AS uniqueness,
  CASE WHEN p_size % 10 = 0 THEN 'UNUSABLE' ELSE 'VALID' END AS status,
  CASE WHEN p_size % 13 = 0 THEN 'INVISIBLE' ELSE 'VISIBLE' END AS visibility,
  CASE WHEN p_size % 4 = 0 THEN 'DEFAULT' ELSE CAST(p_size % 11 AS STRING) END AS degree,
  CASE WHEN p_size % 6 = 0 THEN 'ENABLED' ELSE 'DISABLED' END AS compression,
  concat('TS_', p_partkey % 8) AS tablespace_name
FROM part""")

_role("ind_columns", """
SELECT concat('DB', p_partkey % 150 % 50 % 4) AS db_name,
  CASE WHEN p_size = 50 THEN 'U49' ELSE concat('U', p_partkey % 150 % 50) END AS index_owner, concat('IX_', p_partkey) AS index_name,
  concat('U', p_partkey % 150 % 50) AS table_owner, concat('T_', p_partkey % 150) AS table_name,
  concat('C', p_size % 5) AS column_name, 1 AS column_position
FROM part""")

_role("index_usage", """
SELECT concat('DB', p_partkey % 150 % 50 % 4) AS db_name, concat('U', p_partkey % 150 % 50) AS owner,
  concat(CASE WHEN p_partkey % 5 = 0 THEN 'IX_OLD_' ELSE 'IX_' END, p_partkey) AS index_name,
  concat('T_', p_partkey % 150) AS table_name, CASE WHEN p_size % 3 = 1 THEN 'NO' ELSE 'YES' END AS monitoring,
  CASE WHEN p_size % 2 = 0 THEN 'YES' ELSE 'NO' END AS used, concat('01-', 10 + p_size % 20, '-2024 08:30:00') AS start_monitoring
FROM part""")

# Dictionary-level index usage: index objects (id 1e6 + partkey), their
# tables (id 2e6 + partkey % 150), index flag bits and usage-tracking rows.
_role("ind_flags", """
SELECT concat('DB', p_partkey % 150 % 50 % 4) AS db_name, p_partkey + 1000000 AS obj_id, p_partkey % 150 + 2000000 AS bo_id,
  CAST(CASE WHEN p_size % 3 = 1 THEN 0 ELSE 65536 END + p_size % 4 AS BIGINT) AS flags
FROM part""")

_role("object_usage", """
SELECT concat('DB', p_partkey % 150 % 50 % 4) AS db_name, CASE WHEN p_partkey % 5 = 0 THEN -p_partkey ELSE p_partkey + 1000000 END AS obj_id,
  CAST(CASE WHEN p_size % 2 = 0 THEN 1 ELSE 0 END + 2 * (p_size % 3) AS BIGINT) AS flags,
  concat('01-', 10 + p_size % 20, '-2024 08:30:00') AS start_monitoring, CAST(NULL AS STRING) AS end_monitoring
FROM part""")

_role("dict_objects", """
SELECT concat('DB', p_partkey % 150 % 50 % 4) AS db_name, p_partkey + 1000000 AS obj_id, concat('U', p_partkey % 150 % 50) AS owner,
  concat('IX_', p_partkey) AS name, 'INDEX' AS object_type
FROM part
UNION ALL
SELECT DISTINCT concat('DB', p_partkey % 150 % 50 % 4), p_partkey % 150 + 2000000, concat('U', p_partkey % 150 % 50),
  concat('T_', p_partkey % 150), 'TABLE'
FROM part""")

_role("constraints", """
SELECT concat('DB', p_partkey % 150 % 50 % 4) AS db_name, concat('U', p_partkey % 150 % 50) AS owner,
  CASE WHEN p_partkey % 3 = 0 THEN concat('SYS_C', p_partkey) ELSE concat('CK_', p_partkey) END AS constraint_name,
  concat('T_', p_partkey % 150) AS table_name,
  CASE p_partkey % 4 WHEN 0 THEN 'P' WHEN 3 THEN 'R' ELSE 'U' END AS constraint_type,
  CASE WHEN p_size % 9 = 0 THEN 'DISABLED' ELSE 'ENABLED' END AS status,
  concat('U', p_partkey % 150 % 50) AS index_owner, concat('IX_', p_partkey) AS index_name,
  CASE WHEN p_partkey % 4 = 3 AND p_partkey >= 150 THEN concat('U', p_partkey % 150 % 50) ELSE NULL END AS r_owner,
  CASE WHEN p_partkey % 4 = 3 AND p_partkey >= 150 THEN CASE WHEN p_partkey % 3 = 0 THEN concat('SYS_C', p_partkey - 150) ELSE concat('CK_', p_partkey - 150) END ELSE NULL END AS r_constraint_name
FROM part""")

_role("cons_columns", """
SELECT concat('DB', p_partkey % 150 % 50 % 4) AS db_name, concat('U', p_partkey % 150 % 50) AS owner,
  CASE WHEN p_partkey % 3 = 0 THEN concat('SYS_C', p_partkey) ELSE concat('CK_', p_partkey) END AS constraint_name,
  concat('T_', p_partkey % 150) AS table_name, concat('C', p_size % 5) AS column_name, 1 AS position
FROM part""")

_role("columns", """
SELECT concat('DB', p_partkey % 150 % 50 % 4) AS db_name, concat('U', p_partkey % 150 % 50) AS owner, concat('T_', p_partkey % 150) AS table_name,
  concat('C', p_partkey) AS column_name, CASE WHEN p_size = 7 THEN 'LONG' WHEN p_size % 2 = 0 THEN 'NUMBER' ELSE 'VARCHAR2' END AS data_type,
  CAST(p_size AS BIGINT) AS data_length, CASE WHEN p_size % 3 = 0 THEN 'N' ELSE 'Y' END AS nullable,
  CASE p_partkey % 7 WHEN 0 THEN concat('"U', p_partkey % 50, '"."T_', p_partkey % 150, '".nextval') WHEN 1 THEN concat('seq_', p_partkey, '.nextval') WHEN 2 THEN '0' ELSE NULL END AS data_default
FROM part""")

# ------------------------------------------------------------- objects
_role("objects", """
SELECT concat('DB', o_orderkey % 50 % 4) AS db_name, CASE WHEN o_orderkey % 41 = 0 THEN 'PUBLIC' WHEN o_orderkey % 43 = 0 THEN 'APEX_040200' WHEN o_orderkey % 47 = 0 THEN 'MDSYS' ELSE concat('U', o_orderkey % 50) END AS owner,
  concat('OBJ_', o_orderkey) AS object_name, o_orderkey AS object_id,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'SYNONYM' WHEN '2-HIGH' THEN 'VIEW' WHEN '3-MEDIUM' THEN 'TABLE' WHEN '5-LOW' THEN 'TRIGGER' ELSE 'PACKAGE BODY' END AS object_type,
  CASE WHEN o_orderstatus = 'P' THEN 'INVALID' ELSE 'VALID' END AS status, o_orderdate AS created,
  o_orderdate + INTERVAL 1 DAY * (o_orderkey % 5) AS last_ddl_time,
  CASE WHEN o_orderkey % 3 <> 0 THEN 'ORA$BASE' ELSE NULL END AS edition_name
FROM orders""")

_role("errors", """
SELECT concat('DB', o_orderkey % 50 % 4) AS db_name, concat('U', o_orderkey % 50) AS owner, concat('OBJ_', o_orderkey) AS name,
  CASE o_orderpriority WHEN '2-HIGH' THEN 'VIEW' WHEN '5-LOW' THEN 'TRIGGER' ELSE 'PACKAGE BODY' END AS type, CAST(o_orderkey % 7 + 1 AS BIGINT) AS line, concat('PLS-00', 201 + o_orderkey % 3) AS text
FROM orders""")

_role("triggers", """
SELECT concat('DB', o_orderkey % 50 % 4) AS db_name, CASE WHEN o_orderkey % 41 = 0 THEN 'PUBLIC' WHEN o_orderkey % 43 = 0 THEN 'APEX_040200' WHEN o_orderkey % 47 = 0 THEN 'MDSYS' ELSE concat('U', o_orderkey % 50) END AS owner,
  concat('OBJ_', o_orderkey) AS trigger_name, CASE WHEN o_custkey % 6 = 0 THEN 'AFTER EVENT' ELSE 'BEFORE EACH ROW' END AS trigger_type,
  CASE WHEN o_custkey % 9 = 0 THEN concat('U', o_custkey % 50) ELSE concat('U', o_orderkey % 50) END AS table_owner, concat('T_', o_custkey) AS table_name,
  CASE WHEN o_custkey % 4 = 0 THEN 'DISABLED' ELSE 'ENABLED' END AS status,
  CASE WHEN o_custkey % 6 = 0 THEN 'DATABASE' ELSE 'TABLE' END AS base_object_type
FROM orders WHERE o_orderpriority = '5-LOW'""")

_role("synonyms", """
SELECT concat('DB', o_orderkey % 50 % 4) AS db_name, CASE WHEN o_orderkey % 41 = 0 THEN 'PUBLIC' WHEN o_orderkey % 43 = 0 THEN 'APEX_040200' WHEN o_orderkey % 47 = 0 THEN 'MDSYS' ELSE concat('U', o_orderkey % 50) END AS owner,
  concat('S_', o_orderkey) AS synonym_name,
  concat('U', o_orderkey % 50) AS table_owner, CASE WHEN o_orderkey % 7 = 0 THEN concat('S_', o_orderkey - 50) ELSE concat('T_', o_custkey) END AS table_name
FROM orders WHERE o_orderpriority = '1-URGENT'""")

_role("dependencies", """
SELECT concat('DB', o_orderkey % 50 % 4) AS db_name, CASE WHEN o_orderkey % 41 = 0 THEN 'PUBLIC' WHEN o_orderkey % 43 = 0 THEN 'APEX_040200' WHEN o_orderkey % 47 = 0 THEN 'MDSYS' ELSE concat('U', o_orderkey % 50) END AS owner,
  concat('OBJ_', o_orderkey) AS name, 'VIEW' AS type, concat('U', o_custkey % 50) AS referenced_owner,
  concat('T_', o_custkey % 150) AS referenced_name, 'TABLE' AS referenced_type
FROM orders WHERE o_orderpriority = '2-HIGH'""")

# Object dependency graph with recorded parent timestamps (dictionary level).
# Parent of order k is order k - 50 in the same database; the recorded
# parent timestamp is stale every 6th order; property bit 1 set on odd keys.
_role("obj_dependency", """
SELECT concat('DB', o_orderkey % 50 % 4) AS db_name, o_orderkey AS d_obj, o_orderkey - 50 AS p_obj,
  CASE WHEN o_orderkey % 6 = 0 THEN o_orderdate - INTERVAL 3 DAY ELSE o_orderdate END AS p_timestamp,
  CAST(o_orderkey % 2 AS BIGINT) AS property
FROM orders""")

_role("obj_dict", """
SELECT concat('DB', o_orderkey % 50 % 4) AS db_name, o_orderkey AS obj_id,
  CASE WHEN o_orderkey % 41 = 0 THEN 'PUBLIC' WHEN o_orderkey % 43 = 0 THEN 'APEX_040200' WHEN o_orderkey % 47 = 0 THEN 'MDSYS' ELSE concat('U', o_orderkey % 50) END AS owner,
  concat('OBJ_', o_orderkey) AS name,
  CASE o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 4 WHEN '3-MEDIUM' THEN 2 WHEN '5-LOW' THEN 12 ELSE 11 END AS type_id,
  CASE WHEN o_orderstatus = 'P' THEN 5 ELSE 1 END AS status,
  o_orderdate + INTERVAL 50 DAY AS stime, CASE WHEN o_orderkey % 37 = 0 THEN 'P1' ELSE NULL END AS subname
FROM orders""")

_role("tab_privs", """
SELECT concat('DB', l_partkey % 150 % 50 % 4) AS db_name, concat('U', l_partkey % 150 % 50) AS owner, concat('T_', l_partkey % 150) AS table_name,
  CASE WHEN l_suppkey % 50 = 49 THEN 'APEX_PUBLIC_USER' ELSE concat('U', l_suppkey % 50) END AS grantee,
  CASE l_linenumber WHEN 1 THEN 'SELECT' WHEN 2 THEN 'INSERT' WHEN 3 THEN 'ALTER' WHEN 4 THEN 'INDEX' WHEN 5 THEN 'DEBUG' WHEN 6 THEN 'FLASHBACK' ELSE 'QUERY REWRITE' END AS privilege,
  CASE WHEN l_returnflag = 'R' THEN 'YES' ELSE 'NO' END AS grantable
FROM lineitem
UNION ALL
SELECT concat('DB', o_orderkey % 50 % 4), CASE WHEN o_orderkey % 41 = 0 THEN 'PUBLIC' WHEN o_orderkey % 43 = 0 THEN 'APEX_040200' WHEN o_orderkey % 47 = 0 THEN 'MDSYS' ELSE concat('U', o_orderkey % 50) END,
  concat('OBJ_', o_orderkey), concat('U', (o_orderkey + 4) % 50), CASE WHEN o_orderkey % 3 = 0 THEN 'SELECT' ELSE 'READ' END, 'NO'
FROM orders WHERE o_orderpriority = '2-HIGH'""")

# ---------------------------------------------------------------- users
_role("users", """
SELECT concat('DB', c_custkey % 4) AS db_name, CASE WHEN c_custkey % 61 = 0 THEN concat('SYS', c_custkey) ELSE concat('U', c_custkey) END AS username, c_custkey AS user_id, c_mktsegment AS profile,
  CASE WHEN c_acctbal < 0 THEN 'EXPIRED' WHEN c_custkey % 17 = 0 THEN 'LOCKED' ELSE 'OPEN' END AS account_status,
  CASE WHEN c_custkey % 6 = 0 THEN 'SYSTEM' ELSE 'TEMP' END AS temporary_tablespace,
  concat('TS_', c_custkey % 8) AS default_tablespace,
  TIMESTAMP '2000-01-01 00:00:00' + INTERVAL 1 DAY * (c_custkey % 400) AS created,
  CASE WHEN c_custkey % 17 = 0 THEN TIMESTAMP '2001-07-01 00:00:00' ELSE NULL END AS lock_date,
  CASE WHEN c_acctbal < 0 THEN TIMESTAMP '2001-06-01 00:00:00' + INTERVAL 1 DAY * (c_custkey % 30) ELSE NULL END AS expiry_date,
  CASE WHEN c_custkey % 8 = 0 THEN 'SYS_GROUP' ELSE 'DEFAULT_CONSUMER_GROUP' END AS initial_rsrc_consumer_group, '11G 12C' AS password_versions,
  CASE WHEN c_custkey % 9 = 0 THEN 'Y' ELSE 'N' END AS editions_enabled, CASE WHEN c_custkey % 21 = 0 THEN 'EXTERNAL' ELSE 'PASSWORD' END AS authentication_type
FROM customer
UNION ALL
SELECT concat('DB', c_custkey % 4), 'APP', -1, 'BUILDING', 'OPEN', 'TEMP', 'TS_0', TIMESTAMP '2000-01-01 00:00:00',
  CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP), 'DEFAULT_CONSUMER_GROUP', '11G 12C', 'N', 'PASSWORD'
FROM customer GROUP BY c_custkey % 4""")

_role("user_history", """
SELECT concat('DB', k % 4) AS db_name, k AS user_id, o_orderdate AS password_date
FROM (SELECT o_orderdate, CASE WHEN o_custkey % 3 = 0 THEN o_custkey + 1 ELSE o_custkey END AS k FROM orders) t""")

_role("user_base", """
SELECT concat('DB', c.c_custkey % 4) AS db_name, concat('U', c.c_custkey) AS name, c.c_custkey AS user_id,
  CASE WHEN c.c_acctbal < 0 THEN 4 WHEN c.c_custkey % 17 = 0 THEN 8 ELSE 0 END AS astatus,
  o.last_order AS ptime, CASE WHEN c.c_custkey % 13 = 0 THEN 0 ELSE 1 END AS type_id, c.c_mktsegment AS resource
FROM customer c LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last_order FROM orders GROUP BY o_custkey) o ON o.o_custkey = c.c_custkey""")

_role("users_defpwd", """
SELECT concat('DB', c_custkey % 4) AS db_name, CASE WHEN c_custkey % 19 = 3 THEN 'XS$NULL' ELSE concat('U', c_custkey) END AS username, 'Y' AS product
FROM customer""")

_role("sys_privs", """
SELECT concat('DB', c_custkey % 4) AS db_name, concat('U', c_custkey) AS grantee,
  CASE WHEN c_custkey % 3 = 0 THEN 'UNLIMITED TABLESPACE' ELSE 'CREATE SESSION' END AS privilege
FROM customer
UNION ALL
SELECT concat('DB', c_custkey % 4), concat('R_', c_mktsegment),
  CASE c_custkey % 3 WHEN 0 THEN 'CREATE TABLE' WHEN 1 THEN 'CREATE VIEW' ELSE 'SELECT ANY TABLE' END
FROM customer GROUP BY c_custkey % 4, c_mktsegment, c_custkey % 3""")

_role("ts_quotas", """
SELECT concat('DB', c_custkey % 4) AS db_name, concat('U', c_custkey) AS username, concat('TS_', c_custkey % 8) AS tablespace_name,
  CAST(CASE WHEN c_custkey % 4 = 1 THEN 1048576 ELSE -1 END AS BIGINT) AS max_bytes
FROM customer""")

_role("role_privs", """
SELECT concat('DB', c_custkey % 4) AS db_name, CASE WHEN c_custkey % 10 = 0 THEN 'DBA' ELSE 'CONNECT' END AS granted_role,
  concat(CASE WHEN c_custkey % 70 = 0 THEN 'SYS' WHEN c_custkey % 90 = 0 THEN 'APEX_' ELSE 'U' END, c_custkey) AS grantee, CASE WHEN c_custkey % 20 = 0 THEN 'YES' ELSE 'NO' END AS admin_option
FROM customer""")

_role("roles", """
SELECT concat('DB', c_custkey % 4) AS db_name, concat('R_', c_mktsegment) AS role, 'NO' AS password_required
FROM customer GROUP BY c_custkey % 4, c_mktsegment""")

_role("pwfile_users", """
SELECT concat('DB', c_custkey % 4) AS db_name, CASE WHEN c_custkey % 97 < 4 THEN 'SYS' ELSE concat('U', c_custkey) END AS username, 'TRUE' AS sysdba,
  CASE WHEN c_custkey % 2 = 0 THEN 'TRUE' ELSE 'FALSE' END AS sysoper
FROM customer""")

# ---------------------------------------------------------------- jobs
_role("scheduler_jobs", """
SELECT concat('DB', c_custkey % 50 % 4) AS db_name, concat('U', c_custkey % 50) AS owner, concat('JOB_', c_custkey) AS job_name,
  CASE WHEN c_acctbal < 3000 THEN 'FALSE' ELSE 'TRUE' END AS enabled, CASE WHEN c_custkey % 5 = 0 THEN 'RUNNING' ELSE 'SCHEDULED' END AS state
FROM customer""")

_role("jobs", """
SELECT concat('DB', c_custkey % 50 % 4) AS db_name, concat('U', c_custkey % 50) AS schema_user, c_custkey AS job,
  CASE WHEN c_acctbal < 3000 THEN 'Y' ELSE 'N' END AS broken, concat('do_', c_mktsegment) AS what
FROM customer""")

_role("datapump_jobs", """
SELECT concat('DB', o_orderkey % 50 % 4) AS db_name, CASE WHEN o_orderkey % 41 = 0 THEN 'PUBLIC' WHEN o_orderkey % 43 = 0 THEN 'APEX_040200' WHEN o_orderkey % 47 = 0 THEN 'MDSYS' ELSE concat('U', o_orderkey % 50) END AS owner_name,
  concat('OBJ_', CASE WHEN o_orderkey % 3 = 0 THEN -o_orderkey ELSE o_orderkey END) AS job_name, CASE WHEN o_custkey % 2 = 0 THEN 'EXPORT' ELSE 'IMPORT' END AS operation,
  'SCHEMA' AS job_mode, CASE WHEN o_orderstatus = 'O' THEN 'EXECUTING' ELSE 'NOT RUNNING' END AS state,
  CAST(o_custkey % 2 AS BIGINT) AS attached_sessions
FROM orders""")

_role("sequences", """
SELECT concat('DB', p_partkey % 50 % 4) AS db_name, CASE WHEN p_partkey % 53 = 0 THEN 'SYSTEM' ELSE concat('U', p_partkey % 50) END AS sequence_owner, concat('SEQ_', p_partkey) AS sequence_name,
  CAST(p_size % 3 + 1 AS BIGINT) AS increment_by, 'N' AS cycle_flag, CASE WHEN p_size % 2 = 0 THEN 'Y' ELSE 'N' END AS order_flag,
  CAST(p_size AS BIGINT) * 1000 AS last_number
FROM part""")

_role("sessions", """
SELECT concat('DB', user_id % 4) AS db_name, CAST(user_id % 2 + 1 AS BIGINT) AS inst_id, concat('U', user_id % 50) AS username,
  concat('host', user_id % 7) AS machine, 'ACTIVE' AS status, event_id AS sid,
  CASE WHEN event_type = 'signup' THEN 'USER' ELSE 'BACKGROUND' END AS type, concat('module ', event_type) AS module, concat('client', user_id % 9, '@app') AS program
FROM events""")

_role("sql_profiles", """
SELECT concat('DB', p_partkey % 4) AS db_name, concat('SYS_SQLPROF_', p_partkey) AS name,
  CASE WHEN p_size % 2 = 0 THEN 'ENABLED' ELSE 'DISABLED' END AS status
FROM part""")

_role("directories", """
SELECT concat('DB', s_suppkey % 4) AS db_name, 'SYS' AS owner, concat('DIR_', s_suppkey) AS directory_name,
  concat('/u0', s_suppkey % 5, '/dir/', s_suppkey) AS directory_path
FROM supplier""")

# --------------------------------------------------------------- features
_role("feature_usage", """
SELECT concat('DB', p_partkey % 4) AS db_name,
  CASE p_partkey % 6 WHEN 0 THEN 'Partitioning (user)' WHEN 1 THEN 'Data Guard' WHEN 2 THEN 'HeapCompression' WHEN 3 THEN 'Oracle Utility Datapump (Export)' WHEN 4 THEN 'ADDM' ELSE 'SQL Profile' END AS name,
  concat('19.', p_size % 4) AS version, CASE WHEN p_size % 2 = 0 THEN 'TRUE' ELSE 'FALSE' END AS currently_used,
  CAST(p_size % 5 AS BIGINT) AS detected_usages, CAST(p_size % 3 AS BIGINT) AS total_samples,
  CAST(CASE WHEN p_size % 7 = 0 THEN DATE '2022-06-01' ELSE DATE '2024-01-15' END AS TIMESTAMP) AS last_usage_date,
  CAST(DATE '2023-06-01' AS TIMESTAMP) AS first_usage_date,
  CAST(DATE '2024-01-20' AS TIMESTAMP) AS last_sample_date,
  CASE p_partkey % 6 WHEN 1 THEN CASE WHEN p_size % 2 = 0 THEN 'Compression used: TRUE' ELSE 'Compression used: FALSE' END WHEN 3 THEN 'compression used: 3 times' ELSE NULL END AS feature_info
FROM part""")

# ---------------------------------------------------------- partitions
_role("tab_partitions", """
SELECT DISTINCT concat('DB', m % 4) AS db_name, 'APP' AS table_owner, concat('TAR_SALES_', m % 3) AS table_name,
  CASE WHEN m % 2 = 0 THEN concat('SYS_P', m) ELSE concat('SALES_', m) END AS partition_name, CAST(m AS INT) AS partition_position,
  CASE WHEN m % 5 = 0 THEN 'MAXVALUE' ELSE concat('TO_DATE('' ', y, '-', CASE WHEN mo < 10 THEN '0' ELSE '' END, mo, '-01 00:00:00'')') END AS high_value,
  concat('TS_', m % 8) AS tablespace_name,
  CASE WHEN m % 6 = 1 THEN 'NO' ELSE 'YES' END AS segment_created,
  CASE WHEN m % 4 = 1 THEN 'ENABLED' ELSE 'DISABLED' END AS compression,
  CAST(m * 10 AS BIGINT) AS num_rows,
  CASE WHEN m % 3 = 0 THEN NULL ELSE TIMESTAMP '2001-07-01 00:00:00' END AS last_analyzed
FROM (SELECT year(o_orderdate) AS y, month(o_orderdate) AS mo, year(o_orderdate) * 12 + month(o_orderdate) AS m FROM orders) t
UNION ALL
SELECT DISTINCT concat('DB', d % 4), 'SCOTT', CASE WHEN d % 3 = 0 THEN 'QUEUE' ELSE 'LOG' END, concat('SYS_P', (y * 12 + mo) * 31 + d), CAST((y * 12 + mo) * 31 + d AS INT),
  CASE WHEN d = 31 THEN 'MAXVALUE' ELSE concat('TO_DATE('' ', y, '-', lpad(CAST(mo AS STRING), 2, '0'), '-', lpad(CAST(d AS STRING), 2, '0'), ' 00:00:00'')') END,
  concat('TS_', d % 8), 'YES', 'DISABLED', CAST(d * 10 AS BIGINT), CASE WHEN d % 3 = 0 THEN NULL ELSE TIMESTAMP '2001-07-01 00:00:00' END
FROM (SELECT year(o_orderdate) AS y, month(o_orderdate) AS mo, day(o_orderdate) AS d FROM orders) t
UNION ALL
SELECT DISTINCT concat('DB', m % 4), 'SCOTT', 'HISTORY', concat('SYS_P', m), CAST(m AS INT), concat(y, lpad(CAST(mo AS STRING), 2, '0'), '01'),
  concat('TS_', m % 8), 'YES', 'DISABLED', CAST(m * 10 AS BIGINT), CAST(NULL AS TIMESTAMP)
FROM (SELECT year(o_orderdate) AS y, month(o_orderdate) AS mo, year(o_orderdate) * 12 + month(o_orderdate) AS m FROM orders) t
UNION ALL
SELECT concat('DB', c_custkey % 4), 'SCOTT', 'DETAIL', concat(CASE WHEN c_custkey % 3 = 0 THEN 'DETAIL_' ELSE 'SYS_P' END, c_custkey), CAST(c_custkey AS INT),
  CASE WHEN c_custkey % 19 = 0 THEN 'MAXVALUE' ELSE CAST(c_custkey % 900 + 100 AS STRING) END, concat('TS_', c_custkey % 8), 'YES', 'DISABLED', CAST(c_custkey AS BIGINT), CAST(NULL AS TIMESTAMP)
FROM customer
UNION ALL
SELECT concat('DB', p_partkey % 4), 'APP', concat('EVENT_', p_partkey % 5), concat('SYS_P', p_partkey), CAST(p_partkey AS INT), CAST(p_partkey * 10000 AS STRING),
  concat('TS_', p_partkey % 8), CASE WHEN p_partkey % 6 = 1 THEN 'NO' ELSE 'YES' END, 'DISABLED', CAST(p_partkey AS BIGINT), CAST(NULL AS TIMESTAMP)
FROM part""")

_role("ind_partitions", """
SELECT DISTINCT concat('DB', m % 4) AS db_name, 'APP' AS index_owner, concat('IXP_', m % 3) AS index_name,
  CASE WHEN m % 4 = 0 THEN concat('SYS_P', m) ELSE concat('SYS_I', m) END AS partition_name, CAST(m AS INT) AS partition_position,
  CASE WHEN m % 3 = 0 THEN 'TS_OLD' ELSE concat('TS_', m % 8) END AS tablespace_name, CASE WHEN m % 9 = 0 THEN 'UNUSABLE' ELSE 'USABLE' END AS status
FROM (SELECT year(o_orderdate) * 12 + month(o_orderdate) AS m FROM orders) t""")

_role("part_indexes", """
SELECT concat('DB', c_custkey % 12 % 4) AS db_name, 'APP' AS owner, concat('IXP_', c_custkey % 12 % 3) AS index_name,
  concat('TAR_SALES_', c_custkey % 12 % 3) AS table_name, concat('TS_', c_custkey % 12 % 2) AS def_tablespace_name
FROM customer GROUP BY c_custkey % 12""")

_role("part_tables", """
SELECT concat('DB', c_custkey % 12 % 4) AS db_name, 'APP' AS owner, concat('TAR_SALES_', c_custkey % 12 % 3) AS table_name,
  CASE WHEN c_custkey % 12 % 3 = 0 THEN 'APP_200108' ELSE concat('TS_', c_custkey % 12 % 4) END AS def_tablespace_name,
  CASE WHEN c_custkey % 12 % 3 = 1 THEN 'NUMTOYMINTERVAL(1,''MONTH'')' ELSE NULL END AS interval
FROM customer GROUP BY c_custkey % 12
UNION ALL
SELECT concat('DB', k % 50 % 4), concat('U', k % 50), concat('T_', k),
  CASE k % 3 WHEN 0 THEN 'APP_200108' WHEN 1 THEN 'SHORT_TERM' ELSE 'USERS' END,
  CASE WHEN k % 2 = 0 THEN 'NUMTOYMINTERVAL(1,''MONTH'')' ELSE NULL END
FROM (SELECT c_custkey * 5 AS k FROM customer) t
UNION ALL
SELECT DISTINCT concat('DB', p_partkey % 4), 'APP', concat('EVENT_', p_partkey % 5), 'USERS', CASE WHEN p_partkey % 5 < 3 THEN '10000' ELSE NULL END
FROM part""")

_role("store_lists", """
SELECT concat('DB', c_custkey % 12 % 4) AS db_name, 'APP' AS owner, concat('TAR_SALES_', c_custkey % 12 % 3) AS table_name,
  CASE WHEN c_custkey % 24 < 12 THEN 'APP_200108' ELSE concat('APP_2001', lpad(CAST(c_custkey % 12 + 1 AS STRING), 2, '0')) END AS tablespace_name
FROM customer GROUP BY c_custkey % 12, c_custkey % 24
UNION ALL
SELECT concat('DB', k % 50 % 4), concat('U', k % 50), concat('T_', k),
  CASE k % 4 WHEN 0 THEN 'APP_200108' WHEN 1 THEN 'ETL_200108' ELSE 'USERS' END
FROM (SELECT c_custkey * 5 AS k FROM customer) t""")

# ------------------------------------------------------- files and logs
_role("log_lines", """
SELECT concat('DB', user_id % 4) AS db_name, ts, concat(event_type, ' ', props) AS line FROM events""")

_role("files", """
SELECT concat('DB', doc_id % 4) AS db_name,
  CASE doc_id % 13 WHEN 0 THEN concat('/diag/listener/alert/log_', doc_id, '.xml') WHEN 1 THEN concat('/diag/listener/trace/listener.log_', doc_id, '.gz')
    ELSE concat('/diag/', source, '/f', doc_id, CASE doc_id % 5 WHEN 0 THEN '.trc' WHEN 1 THEN '.trm' WHEN 2 THEN '.aud' WHEN 3 THEN '.xml' ELSE '.tgz' END) END AS path,
  false AS is_dir, CASE WHEN doc_id % 7 = 0 THEN CAST(0 AS BIGINT) ELSE n_chars END AS size_bytes,
  CAST(doc_id % 90 AS INT) AS age_days, CAST((doc_id * 37) % 1440 AS INT) AS age_minutes,
  TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 1 DAY * (doc_id % 90) - INTERVAL 1 MINUTE * ((doc_id * 37) % 1440) AS mtime
FROM documents""")

# ------------------------------------------------------ editions, outages
# Editions of a database form chains of 40 from the base; in every thousand one
# chain closes to a cycle and one names a parent that is gone.
_role("editions", """
SELECT concat('DB', c_custkey % 4) AS db_name, concat('E_', c_custkey) AS edition_name,
  CASE WHEN i % 1000 = 7 THEN concat('E_', c_custkey + 8) WHEN i % 1000 = 45 THEN 'E_GONE' WHEN i % 40 = 0 THEN 'ORA$BASE' ELSE concat('E_', c_custkey - 4) END AS parent_edition_name
FROM (SELECT c_custkey, CAST((c_custkey - c_custkey % 4) / 4 AS BIGINT) AS i FROM customer) t
UNION ALL
SELECT concat('DB', c_custkey % 4), 'ORA$BASE', NULL FROM customer GROUP BY c_custkey % 4""")

_role("edition_comments", """
SELECT concat('DB', c_custkey % 4) AS db_name, concat('E_', c_custkey) AS edition_name, concat('release ', c_mktsegment) AS comments FROM customer""")

_role("edition_privs", """
SELECT concat('DB', c_custkey % 4) AS db_name, concat('E_', c_custkey) AS table_name, concat('U', c_nationkey) AS grantee,
  CASE WHEN c_acctbal < 0 THEN 'ALTER' ELSE 'USE' END AS privilege
FROM customer""")

_role("edition_objects", """
SELECT concat('DB', o_custkey % 4) AS db_name, concat('E_', o_custkey) AS edition_name, concat('OBJ_', o_orderkey) AS object_name,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'SYNONYM' WHEN '2-HIGH' THEN 'VIEW' ELSE 'PACKAGE' END AS object_type,
  CASE WHEN o_orderstatus = 'P' THEN 'INVALID' ELSE 'VALID' END AS status, o_orderdate AS created
FROM orders""")

_role("services", """
SELECT concat('DB', s_suppkey % 4) AS db_name, CASE WHEN s_suppkey % 13 = 0 THEN concat('SYS$', s_suppkey) WHEN s_suppkey % 17 = 0 THEN concat('s', s_suppkey, 'XDB') ELSE concat('svc_', s_suppkey) END AS name,
  CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE concat('E_', s_suppkey) END AS edition
FROM supplier""")

# Most outages last seconds, every 500th two days.
_role("outages", """
SELECT concat('DB', user_id % 4) AS db_name, event_id AS outage_id, ts AS started,
  ts + INTERVAL 1 SECOND * (CASE WHEN event_id % 500 = 0 THEN 172800 ELSE CAST(round(value) AS BIGINT) END) AS ended
FROM events""")

# JSON, name: value pairs, cut JSON, plain text and nothing.
_role("event_details", """
SELECT concat('DB', user_id % 4) AS db_name, event_id,
  CASE event_id % 11 WHEN 0 THEN substr(props, 1, 4) WHEN 1 THEN concat('Compression used: TRUE, samples: ', event_id) WHEN 2 THEN NULL WHEN 3 THEN 'no details' ELSE props END AS info
FROM events""")

_role("log_windows", """
SELECT concat('DB', user_id % 4) AS db_name, event_id AS recid, ts - INTERVAL 1 SECOND * CAST(round(value * 2) AS BIGINT) AS first_time, ts AS next_time
FROM events""")


# --------------------------------------------------------------- loaders

_TABLE_RE = re.compile(r"\b(" + "|".join(DRIVER_TABLES) + r")\b")


def driver_tables_of(sql: str) -> set[str]:
    return set(_TABLE_RE.findall(sql))


# Analysed DataFrames per (session, data dir, name). Only plans are kept:
# nothing is cached in memory, so every action still reads the files.
_PLANS: dict[tuple, tuple] = {}


def _key(spark: SparkSession, sf_dir: str, name: str) -> tuple:
    return (spark.conf.get("spark.app.id", ""), id(spark), os.path.abspath(sf_dir), name)


def _cached(spark: SparkSession, key: tuple):
    hit = _PLANS.get(key)
    return hit[1] if hit is not None and hit[0] is spark else None


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    k = _key(spark, sf_dir, "driver:" + name)
    df = _cached(spark, k)
    if df is None:
        df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
        _PLANS[k] = (spark, df)
    return df


def _view_prefix(sf_dir: str) -> str:
    """Private temp-view prefix per data directory, so the session's own
    views (a user's ``orders``) are never replaced."""
    import hashlib
    return "__estatelens_" + hashlib.sha1(os.path.abspath(sf_dir).encode()).hexdigest()[:10] + "_"


def register_driver_tables(spark: SparkSession, sf_dir: str, names) -> None:
    """Expose the driver parquet tables as private temp views."""
    prefix = _view_prefix(sf_dir)
    for n in sorted(names):
        driver_table(spark, sf_dir, n).createOrReplaceTempView(prefix + n)


def role(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One catalog role as a DataFrame over the driver tables."""
    k = _key(spark, sf_dir, "role:" + name)
    df = _cached(spark, k)
    if df is None:
        sql = ROLE_SQL[name]
        register_driver_tables(spark, sf_dir, driver_tables_of(sql))
        prefix = _view_prefix(sf_dir)
        df = spark.sql(_TABLE_RE.sub(lambda m: prefix + m.group(1), sql))
        _PLANS[k] = (spark, df)
    return df


class Roles:
    """Lazy accessor: ``Roles(spark, sf_dir).data_files`` etc."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark = spark
        self._dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in ROLE_SQL:
            raise AttributeError(f"unknown role {name!r}")
        return role(self._spark, self._dir, name)

    def get(self, name: str) -> DataFrame:
        return getattr(self, name)

    @property
    def spark(self) -> SparkSession:
        return self._spark

    def driver(self, name: str) -> DataFrame:
        """A driver table itself (for operators that take user tables)."""
        return driver_table(self._spark, self._dir, name)


def role_cte(*names: str) -> str:
    """``WITH`` clause naming each role ``cat_<role>`` (oracle side)."""
    return "WITH " + ",\n".join(f"cat_{n} AS ({ROLE_SQL[n]})" for n in names) + "\n"
