"""Registered health queries with their oracle SQL."""

from __future__ import annotations

from estatelens.operators import health as h
from estatelens.plans.registry import register
from estatelens.sources.roles import ORDERS_AS_OF

N = "CAST(NULL AS VARCHAR)"

# Oracle SQL of every FINDING rule, reused by the health report.
FINDING_SQL: dict[str, str] = {}


def _finding(key, sql):
    FINDING_SQL[key] = sql
    return register(key, sql)


@_finding("restore_points", f"""
SELECT 'restore_point' AS rule_id, db_name, {N} AS owner, name AS object_name,
  'Restore point active: ' || name || ' at ' || strftime(time, '%Y-%m-%d %H:%M:%S') AS detail, {N} AS remedy
FROM cat_restore_points""")
def q_restore_points(R):
    return h.restore_points(R.restore_points)


@register("acl_check", """
SELECT d.db_name, coalesce(w.n, 0) AS wildcard_acls, CASE WHEN coalesce(w.n, 0) = 1 THEN 'ACL OK' ELSE 'ACL Error' END AS status
FROM (SELECT DISTINCT db_name FROM cat_databases) d
LEFT JOIN (SELECT db_name, count(*) AS n FROM cat_network_acls WHERE host = '*' GROUP BY db_name) w ON w.db_name = d.db_name""")
def q_acl_check(R):
    return h.acl_check(R.databases, R.network_acls)


@_finding("registry_problems", f"""
SELECT 'registry_problem' AS rule_id, db_name, {N} AS owner, comp_id AS object_name, status || ' ' || comp_name AS detail, {N} AS remedy
FROM cat_registry WHERE status <> 'VALID'""")
def q_registry_problems(R):
    return h.registry_problems(R.registry)


@_finding("index_owner_mismatch", f"""
SELECT 'index_owner_mismatch' AS rule_id, db_name, owner, index_name AS object_name,
  'table ' || table_owner || '.' || table_name AS detail, {N} AS remedy
FROM cat_indexes WHERE owner <> table_owner""")
def q_index_owner_mismatch(R):
    return h.index_owner_mismatch(R.indexes)


@_finding("deprecated_type_columns", f"""
SELECT 'deprecated_type' AS rule_id, db_name, owner, table_name AS object_name, 'LONG column ' || column_name AS detail, {N} AS remedy
FROM cat_columns WHERE data_type = 'LONG' AND owner NOT LIKE 'APEX%' AND owner NOT IN (SELECT owner FROM cat_internal_owners)""")
def q_deprecated_type_columns(R):
    return h.deprecated_type_columns(R.columns, R.internal_owners)


@_finding("unusable_indexes", """
SELECT DISTINCT 'unusable_index' AS rule_id, db_name, owner, index_name AS object_name,
  concat('uniqueness=', uniqueness) AS detail, remedy FROM (
  SELECT db_name, owner, index_name, uniqueness, 'alter index ' || owner || '.' || index_name || ' rebuild nologging online;' AS remedy
  FROM cat_indexes WHERE status = 'UNUSABLE'
  UNION ALL
  SELECT p.db_name, p.index_owner, p.index_name, i.uniqueness,
    'alter index ' || p.index_owner || '.' || p.index_name || ' rebuild partition ' || p.partition_name || ' nologging online;'
  FROM cat_ind_partitions p LEFT JOIN cat_indexes i ON i.db_name = p.db_name AND i.owner = p.index_owner AND i.index_name = p.index_name
  WHERE p.status = 'UNUSABLE') u""")
def q_unusable_indexes(R):
    return h.unusable_indexes(R.indexes, R.ind_partitions)


@_finding("nonunique_index_on_key", f"""
SELECT 'nonunique_key_index' AS rule_id, c.db_name, c.owner, c.constraint_name AS object_name,
  c.constraint_type || ' on ' || c.owner || '.' || c.table_name || ' index ' || c.index_owner || '.' || c.index_name AS detail, {N} AS remedy
FROM cat_constraints c JOIN cat_indexes i ON i.db_name = c.db_name AND i.owner = c.index_owner AND i.index_name = c.index_name
WHERE c.constraint_type IN ('P', 'U') AND i.uniqueness = 'NONUNIQUE'""")
def q_nonunique_index_on_key(R):
    return h.nonunique_index_on_key(R.constraints, R.indexes)


@_finding("chained_synonyms", f"""
SELECT 'chained_synonym' AS rule_id, s.db_name, s.owner, s.synonym_name AS object_name,
  'points to synonym ' || s.table_owner || '.' || s.table_name AS detail, {N} AS remedy
FROM cat_synonyms s
WHERE EXISTS (SELECT 1 FROM cat_synonyms t WHERE t.db_name = s.db_name AND t.owner = s.table_owner AND t.synonym_name = s.table_name)""")
def q_chained_synonyms(R):
    return h.chained_synonyms(R.synonyms)


@_finding("invalid_synonyms", f"""
SELECT DISTINCT 'invalid_synonym' AS rule_id, db_name, owner, object_name, {N} AS detail,
  CASE WHEN owner = 'PUBLIC' THEN 'alter public synonym ' || object_name || ' compile;'
       ELSE 'alter synonym ' || owner || '.' || object_name || ' compile;' END AS remedy
FROM cat_objects WHERE status = 'INVALID' AND object_type = 'SYNONYM'""")
def q_invalid_synonyms(R):
    return h.invalid_synonyms(R.objects)


@_finding("invalid_objects", f"""
SELECT 'invalid_object' AS rule_id, db_name, owner, object_name, object_type || ' ' || owner || '.' || object_name AS detail, {N} AS remedy
FROM cat_objects WHERE status <> 'VALID'""")
def q_invalid_objects(R):
    return h.invalid_objects(R.objects)


@register("invalid_object_count", """
SELECT d.db_name, coalesce(t.n, 0) AS invalid_objects FROM (SELECT DISTINCT db_name FROM cat_databases) d LEFT JOIN (
  SELECT db_name, count(*) AS n FROM cat_objects WHERE status <> 'VALID' AND object_type NOT IN ('MATERIALIZED VIEW')
  GROUP BY db_name) t ON t.db_name = d.db_name""")
def q_invalid_object_count(R):
    return h.invalid_object_count(R.objects, exclude_types=("MATERIALIZED VIEW",), databases=R.databases)


@_finding("stale_dependents", f"""
SELECT 'stale_dependent' AS rule_id, o.db_name, o.owner, o.object_name, {N} AS detail,
  'alter session set edition=' || o.edition_name || ';' || chr(10) ||
  CASE WHEN o.object_type = 'PACKAGE BODY' THEN 'alter package ' || o.owner || '.' || o.object_name || ' compile body;'
       ELSE 'alter ' || o.object_type || ' ' || o.owner || '.' || o.object_name || ' compile;' END AS remedy
FROM cat_objects o
WHERE o.edition_name IS NOT NULL AND EXISTS (
  SELECT 1 FROM cat_obj_dependency dep
  JOIN cat_obj_dict d ON d.db_name = dep.db_name AND d.obj_id = dep.d_obj
  JOIN cat_obj_dict p ON p.db_name = dep.db_name AND p.obj_id = dep.p_obj
  WHERE d.status = 1 AND p.status = 1 AND p.stime <> dep.p_timestamp AND dep.db_name = o.db_name AND dep.d_obj = o.object_id)""")
def q_stale_dependents(R):
    return h.stale_dependents(R.objects, R.obj_dict, R.obj_dependency)


@_finding("dependency_mismatch", """
WITH dd AS MATERIALIZED (
  SELECT dep.db_name, dep.p_obj, dep.p_timestamp, d.owner AS d_owner, d.name AS d_name, d.type_id AS d_type
  FROM cat_obj_dependency dep JOIN cat_obj_dict d ON d.db_name = dep.db_name AND d.obj_id = dep.d_obj
  WHERE d.status = 1 AND d.subname IS NULL AND (dep.property & 1) = 1),
e AS (
  SELECT dd.db_name, dd.d_owner, dd.d_name, p.owner AS p_owner, p.name AS p_name
  FROM dd JOIN cat_obj_dict p ON p.db_name = dd.db_name AND p.obj_id = dd.p_obj
  WHERE NOT (p.type_id = 32 AND dd.d_type = 1) AND NOT (p.type_id = 29 AND dd.d_type = 5)
    AND NOT (p.type_id IN (5, 13) AND dd.d_type IN (2, 55))
    AND (p.status NOT IN (1, 2, 4) OR p.stime <> dd.p_timestamp)),
n AS (SELECT DISTINCT db_name, owner, object_name FROM (
        SELECT db_name, d_owner AS owner, d_name AS object_name FROM e
        UNION ALL SELECT db_name, p_owner, p_name FROM e) u)
SELECT DISTINCT 'dependency_mismatch' AS rule_id, o.db_name, o.owner, o.object_name, CAST(NULL AS VARCHAR) AS detail,
  'alter ' || o.object_type || ' ' || o.owner || '.' || o.object_name || ' compile;' AS remedy
FROM cat_objects o JOIN n ON n.db_name = o.db_name AND n.owner = o.owner AND n.object_name = o.object_name""")
def q_dependency_mismatch(R):
    return h.dependency_mismatch(R.objects, R.obj_dict, R.obj_dependency)


@_finding("broken_triggers", f"""
SELECT 'broken_trigger' AS rule_id, t.db_name, t.owner, t.trigger_name AS object_name,
  'Broken trigger: ' || t.owner || '.' || t.trigger_name AS detail, {N} AS remedy
FROM cat_triggers t JOIN cat_objects o
  ON o.db_name = t.db_name AND o.owner = t.owner AND o.object_name = t.trigger_name AND o.object_type = 'TRIGGER'
WHERE o.status <> 'VALID' AND t.status = 'ENABLED'""")
def q_broken_triggers(R):
    return h.broken_triggers(R.triggers, R.objects)


@_finding("trigger_owner_mismatch", f"""
SELECT 'trigger_owner_mismatch' AS rule_id, db_name, owner, trigger_name AS object_name,
  'table ' || table_owner || '.' || table_name AS detail, {N} AS remedy
FROM cat_triggers WHERE owner <> table_owner AND trigger_type NOT LIKE '%EVENT'""")
def q_trigger_owner_mismatch(R):
    return h.trigger_owner_mismatch(R.triggers)


@_finding("disabled_triggers", f"""
SELECT 'disabled_trigger' AS rule_id, db_name, owner, trigger_name AS object_name, status AS detail, {N} AS remedy
FROM cat_triggers WHERE status <> 'ENABLED' AND owner NOT LIKE 'APEX%' AND owner NOT IN (SELECT owner FROM cat_internal_owners)""")
def q_disabled_triggers(R):
    return h.disabled_triggers(R.triggers, R.internal_owners)


@_finding("leftover_jobs", """
SELECT 'leftover_datapump_job' AS rule_id, j.db_name, j.owner_name AS owner, j.job_name AS object_name,
  rtrim(j.operation) || ' ' || rtrim(j.job_mode) || ' ' || j.state || ' sessions=' || CAST(j.attached_sessions AS VARCHAR) AS detail,
  CASE WHEN EXISTS (SELECT 1 FROM cat_objects o WHERE o.db_name = j.db_name AND o.owner = j.owner_name AND o.object_name = j.job_name)
       THEN 'drop table ' || j.owner_name || '.' || j.job_name || ';' END AS remedy
FROM cat_datapump_jobs j WHERE j.state = 'NOT RUNNING'""")
def q_leftover_jobs(R):
    return h.leftover_jobs(R.datapump_jobs, R.objects)


@_finding("stale_table_stats", f"""
SELECT 'stale_table_stats' AS rule_id, t.db_name, t.owner, t.table_name AS object_name,
  concat('num_rows=', CAST(t.num_rows AS VARCHAR)) AS detail,
  'exec DBMS_STATS.GATHER_TABLE_STATS(''' || t.owner || ''',''' || t.table_name || ''');' AS remedy
FROM cat_tables t
WHERE t.temporary = 'N' AND t.secondary = 'N' AND t.segment_created = 'YES' AND t.table_name NOT LIKE 'SYS%'
  AND (t.last_analyzed IS NULL OR t.last_analyzed < TIMESTAMP '{ORDERS_AS_OF}' - INTERVAL 30 DAY)
  AND t.owner NOT LIKE '%SYS%' AND t.owner <> 'XDB'
  AND EXISTS (SELECT 1 FROM cat_tab_stats s WHERE s.db_name = t.db_name AND s.owner = t.owner AND s.table_name = t.table_name
              AND s.stattype_locked IS NULL)
  AND NOT EXISTS (SELECT 1 FROM cat_externals x WHERE x.db_name = t.db_name AND x.owner = t.owner AND x.name = t.table_name)""")
def q_stale_table_stats(R):
    return h.stale_table_stats(R.tables, R.tab_stats, R.externals, ORDERS_AS_OF, age_days=30)


@_finding("unanalyzed_partitions", """
SELECT 'unanalyzed_partition' AS rule_id, t.db_name, t.table_owner AS owner, t.partition_name AS object_name, t.table_name AS detail,
  'exec DBMS_STATS.GATHER_TABLE_STATS(''' || t.table_owner || ''',''"' || t.table_name || '"'',''' || t.partition_name ||
  ''',granularity=>''APPROX_GLOBAL AND PARTITION'',CASCADE=>TRUE);' AS remedy
FROM cat_tab_partitions t
WHERE t.segment_created = 'YES' AND t.last_analyzed IS NULL AND t.table_name NOT LIKE 'SYS%'
  AND EXISTS (SELECT 1 FROM cat_tab_stats s WHERE s.db_name = t.db_name AND s.owner = t.table_owner AND s.table_name = t.table_name
              AND s.partition_name = t.partition_name AND s.stattype_locked IS NULL)
  AND NOT EXISTS (SELECT 1 FROM cat_externals x WHERE x.db_name = t.db_name AND x.owner = t.table_owner AND x.name = t.table_name)""")
def q_unanalyzed_partitions(R):
    return h.unanalyzed_partitions(R.tab_partitions, R.tab_stats, R.externals)


@register("config_parameters", """
SELECT db_name, name, value FROM cat_parameters
WHERE value IS NOT NULL AND (
  ((name LIKE 'log_archive_%' OR name LIKE 'fal%' OR name LIKE 'db%name') AND name NOT LIKE 'log_archive_dest_state%')
  OR (name LIKE 'log_archive_dest_state%' AND upper(value) <> 'ENABLE'))""")
def q_config_parameters(R):
    return h.config_parameters(R.parameters)


@register("maintenance_gate", """
WITH g AS (
  SELECT d.db_name, d.flashback_on, coalesce(r.n, 0) AS restore_points, coalesce(upper(c.value) = 'TRUE', false) AS is_clone
  FROM cat_databases d
  LEFT JOIN (SELECT db_name, count(*) AS n FROM cat_restore_points GROUP BY db_name) r ON r.db_name = d.db_name
  LEFT JOIN (SELECT db_name, value FROM cat_parameters WHERE name = 'clonedb') c ON c.db_name = d.db_name),
f AS (SELECT *, NOT (flashback_on = 'NO' OR (flashback_on = 'RESTORE POINT ONLY' AND restore_points = 0)) AS fb FROM g)
SELECT db_name, flashback_on, restore_points, is_clone, (NOT fb AND NOT is_clone) AS may_run,
  CASE WHEN fb THEN 'flashback active' WHEN is_clone THEN 'clone database' END AS reason
FROM f""")
def q_maintenance_gate(R):
    return h.maintenance_gate(R.databases, R.restore_points, R.parameters)


@register("stale_table_stats_by_profile", f"""
SELECT 'stale_table_stats' AS rule_id, t.db_name, t.owner, t.table_name AS object_name,
  concat('num_rows=', CAST(t.num_rows AS VARCHAR)) AS detail,
  'exec DBMS_STATS.GATHER_TABLE_STATS(''' || t.owner || ''',''"' || t.table_name || '"'',CASCADE=>TRUE);' AS remedy
FROM cat_tables t
WHERE t.temporary = 'N' AND t.secondary = 'N' AND t.segment_created = 'YES' AND t.table_name NOT LIKE 'SYS%'
  AND (t.last_analyzed IS NULL OR t.last_analyzed < TIMESTAMP '{ORDERS_AS_OF}' - INTERVAL 30 DAY)
  AND t.num_rows < 50000 AND t.tablespace_name <> 'TS_3'
  AND EXISTS (SELECT 1 FROM cat_users u WHERE u.profile = 'BUILDING' AND u.db_name = t.db_name AND u.username = t.owner)
  AND EXISTS (SELECT 1 FROM cat_tab_stats s WHERE s.db_name = t.db_name AND s.owner = t.owner AND s.table_name = t.table_name
              AND s.stattype_locked IS NULL)
  AND NOT EXISTS (SELECT 1 FROM cat_externals x WHERE x.db_name = t.db_name AND x.owner = t.owner AND x.name = t.table_name)""")
def q_stale_table_stats_by_profile(R):
    """The stats-gathering form: users of a profile, a row limit and a caller's predicate."""
    return h.stale_table_stats(R.tables, R.tab_stats, R.externals, ORDERS_AS_OF, owners=R.users.filter("profile = 'BUILDING'"),
                               max_rows=50000, predicate="tablespace_name <> 'TS_3'", cascade=True)


@register("unanalyzed_partitions_by_profile", f"""
SELECT 'unanalyzed_partition' AS rule_id, t.db_name, t.table_owner AS owner, t.partition_name AS object_name, t.table_name AS detail,
  'exec DBMS_STATS.GATHER_TABLE_STATS(''' || t.table_owner || ''',''"' || t.table_name || '"'',''' || t.partition_name ||
  ''',granularity=>''APPROX_GLOBAL AND PARTITION'',CASCADE=>TRUE);' AS remedy
FROM cat_tab_partitions t
WHERE t.segment_created = 'YES' AND (t.last_analyzed IS NULL OR t.last_analyzed < TIMESTAMP '{ORDERS_AS_OF}' - INTERVAL 10 DAY)
  AND t.table_name NOT LIKE 'SYS%' AND t.num_rows < 1000000 AND t.tablespace_name <> 'TS_3'
  AND EXISTS (SELECT 1 FROM cat_users u WHERE u.profile = 'BUILDING' AND u.db_name = t.db_name AND u.username = t.table_owner)
  AND EXISTS (SELECT 1 FROM cat_tab_stats s WHERE s.db_name = t.db_name AND s.owner = t.table_owner AND s.table_name = t.table_name
              AND s.partition_name = t.partition_name AND s.stattype_locked IS NULL)
  AND NOT EXISTS (SELECT 1 FROM cat_externals x WHERE x.db_name = t.db_name AND x.owner = t.table_owner AND x.name = t.table_name)""")
def q_unanalyzed_partitions_by_profile(R):
    return h.unanalyzed_partitions(R.tab_partitions, R.tab_stats, R.externals, owners=R.users.filter("profile = 'BUILDING'"),
                                   as_of=ORDERS_AS_OF, age_days=10, max_rows=1000000, predicate="tablespace_name <> 'TS_3'")
