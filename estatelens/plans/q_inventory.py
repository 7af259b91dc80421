"""Registered inventory, state-capture and diff queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from estatelens.operators import inventory as inv
from estatelens.plans.registry import register

_NOT_INT = "NOT IN (SELECT owner FROM cat_internal_owners)"


@register("inv_database", """
SELECT DISTINCT * FROM (
  SELECT db_name, concat('version: ', version) AS line FROM cat_instance
  UNION ALL SELECT db_name, concat('spfile location: ', value) FROM cat_parameters WHERE name = 'spfile'
  UNION ALL SELECT db_name, concat('database: ', dbid, ',', name, ',', db_unique_name, ',', strftime(created, '%Y-%m-%d %H:%M:%S'), ',',
    log_mode, ',', open_mode, ',', database_role, ',', primary_db_unique_name) FROM cat_databases
  UNION ALL SELECT db_name, concat('patch: ', strftime(action_time, '%Y-%m-%d %H:%M:%S'), ',', action, ',', namespace, ',', version, ',', id, ',',
    bundle_series, ',', comments)
  FROM cat_registry_history) x""")
def q_inv_database(R):
    return inv.inv_database(R.instance, R.parameters, R.databases, R.registry_history)


@register("inv_profiles_directories", """
SELECT DISTINCT * FROM (
  SELECT db_name, 'SQL Profiles: ' || CAST(count(*) AS VARCHAR) AS line FROM cat_sql_profiles GROUP BY db_name
  UNION ALL SELECT db_name, concat('Directory: ', owner, '.', directory_name, ' ', directory_path) FROM cat_directories) x""")
def q_inv_profiles_directories(R):
    return inv.inv_profiles_directories(R.sql_profiles, R.directories)


@register("inv_containers", """
SELECT DISTINCT * FROM (
  SELECT c.db_name, concat(c.name, ' ', c.con_id, ' ', i.host_name, ' ', c.db_name, ' ', c.open_mode) AS line
  FROM cat_containers c LEFT JOIN cat_instance i ON i.db_name = c.db_name
  UNION ALL SELECT db_name, 'PDB: ' || name FROM cat_containers WHERE name NOT IN ('CDB$ROOT', 'PDB$SEED')) x""")
def q_inv_containers(R):
    return inv.inv_containers(R.containers, R.instance)


@register("inv_saved_states", """
SELECT DISTINCT * FROM (
  SELECT db_name, concat('SavedState: ', con_name, ' ', state) AS line FROM cat_saved_states
  UNION ALL SELECT db_name, concat('LogMode: ', name, ' ', log_mode) FROM cat_databases
  UNION ALL SELECT db_name, concat('LocalUndo: ', property_value) FROM cat_db_properties WHERE property_name = 'LOCAL_UNDO_ENABLED') x""")
def q_inv_saved_states(R):
    return inv.inv_saved_states(R.saved_states, R.databases, R.db_properties)


@register("inv_users", """
SELECT db_name, username, account_status, lock_date, expiry_date, default_tablespace, temporary_tablespace, created, profile,
  initial_rsrc_consumer_group, password_versions, editions_enabled, authentication_type
FROM cat_users""")
def q_inv_users(R):
    return inv.inv_users(R.users)


@register("inv_segments", f"""
SELECT DISTINCT db_name, concat(owner, '.', segment_name, ',', segment_type, ',', tablespace_name) AS line FROM cat_segments
WHERE segment_name NOT LIKE 'BIN%' AND segment_name NOT LIKE 'SYS%' AND owner NOT LIKE '%SYS%' AND owner NOT LIKE 'APEX%'
  AND owner {_NOT_INT}""")
def q_inv_segments(R):
    return inv.inv_segments(R.segments, R.internal_owners)


@register("inv_objects", f"""
SELECT DISTINCT db_name, concat(owner, '.', object_name, ',', object_type, ',', status) AS line FROM cat_objects
WHERE object_name NOT LIKE 'BIN%' AND owner NOT LIKE '%SYS%' AND owner {_NOT_INT}""")
def q_inv_objects(R):
    return inv.inv_objects(R.objects, R.internal_owners)


@register("inv_columns", f"""
SELECT DISTINCT * FROM (
  SELECT c.db_name, concat('Cons,', c.owner, '.', c.table_name, ',', c.constraint_type, ',', cc.column_name, ',', cc.position, ',',
    c.status, ',', c.constraint_name) AS line
  FROM cat_constraints c JOIN cat_cons_columns cc ON cc.db_name = c.db_name AND cc.owner = c.owner AND cc.constraint_name = c.constraint_name
  WHERE c.owner NOT LIKE '%SYS%' AND c.owner {_NOT_INT} AND c.constraint_type IN ('P', 'U')
  UNION ALL
  SELECT t.db_name, concat('column,', t.owner, '.', t.table_name, ',', t.column_name, ',', t.data_type, ',', t.data_length, ',', t.nullable)
  FROM cat_columns t
  WHERE t.owner NOT LIKE '%SYS%' AND t.owner {_NOT_INT}
    AND NOT EXISTS (SELECT 1 FROM cat_views v WHERE v.db_name = t.db_name AND v.owner = t.owner AND v.view_name = t.table_name)) x""")
def q_inv_columns(R):
    return inv.inv_columns(R.constraints, R.cons_columns, R.columns, R.views, R.internal_owners)


@register("inv_schemas", f"""
SELECT DISTINCT db_name, owner AS line FROM cat_tables WHERE owner {_NOT_INT} AND owner NOT IN ('MIGRATION')""")
def q_inv_schemas(R):
    return inv.inv_schemas(R.tables, R.internal_owners)


@register("inv_jobs", """
SELECT DISTINCT * FROM (
  SELECT db_name, concat('Scheduler: ', owner, ',', job_name, ',', enabled, ',', state) AS line FROM cat_scheduler_jobs
  UNION ALL SELECT db_name, concat('Job: ', schema_user, ',', job, ',', broken, ',', what) FROM cat_jobs) x""")
def q_inv_jobs(R):
    return inv.inv_jobs(R.scheduler_jobs, R.jobs)


@register("inv_storage", """
SELECT DISTINCT * FROM (
  SELECT db_name, concat(contents, ' Tablespace ', tablespace_name, ',', block_size, ',', initial_extent, ',', extent_management, ',', allocation_type, ',',
    segment_space_management, ',', bigfile) AS line FROM cat_tablespaces
  UNION ALL SELECT db_name, concat('Tempspace Group: ', group_name, ' ', tablespace_name) FROM cat_ts_groups
  UNION ALL SELECT db_name, concat('Datafile: ', tablespace_name, ' ', file_name, ',', bytes, ',', maxbytes, ',', autoextensible, ',', increment_by)
  FROM cat_data_files
  UNION ALL SELECT db_name, concat('Tempfile: ', tablespace_name, ' ', file_name, ',', bytes, ',', maxbytes, ',', autoextensible, ',', increment_by)
  FROM cat_temp_files
  UNION ALL SELECT db_name, concat('Online Redo - thread: ', thread, '  group: ', group_no, ' size: ', CAST(bytes / 1073741824 AS VARCHAR),
    ' GB  members: ', members) FROM cat_redo
  UNION ALL SELECT db_name, concat('Standby Redo - thread: ', thread, '  group: ', group_no, ' size: ', CAST(bytes / 1073741824 AS VARCHAR), ' GB')
  FROM cat_standby_redo) x""")
def q_inv_storage(R):
    return inv.inv_storage(R.tablespaces, R.ts_groups, R.data_files, R.temp_files, R.redo, R.standby_redo)


def _owned(table, owner, cols):
    parts = ", ',', ".join([owner, *cols])
    return (f"SELECT DISTINCT db_name, concat({parts}) AS line FROM cat_{table} "
            f"WHERE {owner} NOT LIKE 'APEX%' AND {owner} {_NOT_INT}")


@register("inv_tables", _owned("tables", "owner", ["table_name", "temporary"]))
def q_inv_tables(R):
    return inv.inv_tables(R.tables, R.internal_owners)


@register("inv_indexes", _owned("indexes", "owner", ["table_name", "index_name", "index_type", "uniqueness", "compression"]))
def q_inv_indexes(R):
    return inv.inv_indexes(R.indexes, R.internal_owners)


@register("inv_views", _owned("views", "owner", ["view_name"]))
def q_inv_views(R):
    return inv.inv_views(R.views, R.internal_owners)


@register("inv_sequences", _owned("sequences", "sequence_owner", ["sequence_name", "increment_by", "cycle_flag", "order_flag"]))
def q_inv_sequences(R):
    return inv.inv_sequences(R.sequences, R.internal_owners)


@register("inv_triggers", _owned("triggers", "owner", ["trigger_name", "trigger_type", "table_name", "status"]))
def q_inv_triggers(R):
    return inv.inv_triggers(R.triggers, R.internal_owners)


@register("state_capture", """
SELECT db_name, 'Object counts' AS section, CAST(count(*) AS VARCHAR) AS line FROM cat_objects GROUP BY db_name
UNION ALL SELECT db_name, 'Invalid objects', concat(object_name, ',', owner, ',', object_type) FROM cat_objects WHERE status <> 'VALID'
UNION ALL SELECT db_name, 'Errors', concat(owner, ',', name, ',', text) FROM cat_errors
UNION ALL SELECT db_name, 'Sequences', concat(sequence_owner, ',', sequence_name, ',', last_number) FROM cat_sequences
  WHERE sequence_owner NOT IN ('SYS', 'SYSTEM', 'DBSNMP')
UNION ALL SELECT db_name, 'Connections', concat(username, ',', substr(concat(module, ':', program), 1, 30), ',', machine)
  FROM cat_sessions WHERE type = 'USER'""")
def q_state_capture(R):
    return inv.state_capture(R.objects, R.errors, R.sequences, R.sessions)


# Scenario: the earlier snapshot holds the objects created before 2000,
# with every 11th object's status the other way round.
_BEFORE = """(SELECT db_name, owner, object_name, object_type,
   CASE WHEN object_id % 11 = 0 THEN CASE WHEN status = 'VALID' THEN 'INVALID' ELSE 'VALID' END ELSE status END AS status
 FROM cat_objects WHERE created < TIMESTAMP '2000-01-01 00:00:00')"""


@register("snapshot_diff", f"""
SELECT coalesce(b.db_name, a.db_name) AS db_name, coalesce(b.owner, a.owner) AS owner,
  coalesce(b.object_name, a.object_name) AS object_name, coalesce(b.object_type, a.object_type) AS object_type,
  CASE WHEN b.db_name IS NULL THEN 'added' WHEN a.db_name IS NULL THEN 'removed' ELSE 'changed' END AS change,
  b.status AS before_status, a.status AS after_status
FROM {_BEFORE} b
FULL OUTER JOIN (SELECT db_name, owner, object_name, object_type, status FROM cat_objects) a
  ON a.db_name = b.db_name AND a.owner = b.owner AND a.object_name = b.object_name AND a.object_type = b.object_type
WHERE b.db_name IS NULL OR a.db_name IS NULL OR b.status IS DISTINCT FROM a.status""")
def q_snapshot_diff(R):
    o = R.objects
    flip = F.when(F.col("status") == "VALID", "INVALID").otherwise("VALID")
    before = (o.filter(F.col("created") < F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"))
              .withColumn("status", F.when(F.col("object_id") % 11 == 0, flip).otherwise(F.col("status"))))
    keys = ["db_name", "owner", "object_name", "object_type"]
    return inv.snapshot_diff(before.select(*keys, "status"), o.select(*keys, "status"), keys)
