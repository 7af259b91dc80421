"""Registered constraint, job and index-usage queries."""

from __future__ import annotations

from estatelens.operators import objects as ob
from estatelens.plans.registry import register


@register("constraint_toggle_plan", """
SELECT db_name, owner, table_name, constraint_name, 'disable' AS action,
  'alter table ' || owner || '."' || table_name || '" disable constraint ' || constraint_name || ';' AS remedy FROM cat_constraints
UNION ALL
SELECT db_name, owner, table_name, constraint_name, 'enable',
  'alter table ' || owner || '.' || table_name || ' enable constraint ' || constraint_name || ';' FROM cat_constraints""")
def q_constraint_toggle_plan(R):
    return ob.constraint_toggle_plan(R.constraints)


_OWN = "owner NOT LIKE '%SYS%' AND owner NOT IN ('DBSNMP', 'XDB')"


@register("unique_key_rename_plan", f"""
WITH u AS (SELECT * FROM cat_constraints WHERE {_OWN} AND constraint_type = 'U'),
multi AS (SELECT db_name, owner, table_name FROM u GROUP BY db_name, owner, table_name HAVING count(*) > 1),
f AS (SELECT db_name, owner, table_name, constraint_name, min(column_name) AS first_column FROM cat_cons_columns
      GROUP BY db_name, owner, table_name, constraint_name),
k AS (SELECT u.db_name, u.owner, u.table_name, u.constraint_name, u.index_name, f.first_column
      FROM u JOIN multi m ON m.db_name = u.db_name AND m.owner = u.owner AND m.table_name = u.table_name
      JOIN f ON f.db_name = u.db_name AND f.owner = u.owner AND f.table_name = u.table_name AND f.constraint_name = u.constraint_name
      WHERE u.constraint_name LIKE 'SYS%'),
n AS (SELECT *, 'UK' || CAST(row_number() OVER (PARTITION BY db_name, owner, table_name
                                               ORDER BY first_column NULLS LAST, constraint_name) AS VARCHAR) || '_' || table_name AS new_name
      FROM k)
SELECT db_name, owner, table_name, constraint_name, new_name, 'constraint' AS target,
  'ALTER TABLE ' || owner || '.' || table_name || ' RENAME CONSTRAINT ' || constraint_name || ' TO ' || new_name || ';' AS remedy FROM n
UNION ALL
SELECT db_name, owner, table_name, constraint_name, new_name, 'index',
  'ALTER INDEX ' || owner || '.' || index_name || ' RENAME TO ' || new_name || ';' FROM n""")
def q_unique_key_rename_plan(R):
    return ob.unique_key_rename_plan(R.constraints, R.cons_columns)


@register("key_rename_plan", f"""
SELECT DISTINCT db_name, owner, table_name,
  'ALTER TABLE ' || owner || '.' || table_name || ' RENAME CONSTRAINT ' || constraint_name || ' TO ' ||
    CASE WHEN constraint_type = 'P' THEN 'PK_' ELSE 'UK_' END || substr(table_name, 1, 27) AS constraint_ddl,
  'ALTER INDEX ' || owner || '.' || index_name || ' RENAME TO ' ||
    CASE WHEN constraint_type = 'P' THEN 'PK_' ELSE 'UK_' END || substr(table_name, 1, 27) AS index_ddl
FROM cat_constraints WHERE {_OWN} AND constraint_name LIKE 'SYS%' AND constraint_type IN ('P', 'U')""")
def q_key_rename_plan(R):
    return ob.key_rename_plan(R.constraints)


@register("job_toggle_plan", """
SELECT db_name, 'disable' AS phase, 'scheduler' AS kind, owner || '.' || job_name AS job,
  'exec sys.dbms_scheduler.disable(''' || owner || '.' || job_name || ''')' AS command FROM cat_scheduler_jobs WHERE enabled = 'TRUE'
UNION ALL
SELECT db_name, 'disable', 'job', CAST(job AS VARCHAR), 'exec sys.dbms_ijob.broken(' || CAST(job AS VARCHAR) || ', TRUE)'
FROM cat_jobs WHERE broken = 'N'
UNION ALL
SELECT db_name, 'stop', 'scheduler', owner || '.' || job_name,
  'exec sys.dbms_scheduler.stop_job(''' || owner || '.' || job_name || ''', TRUE)' FROM cat_scheduler_jobs
WHERE enabled = 'TRUE' AND state = 'RUNNING'
UNION ALL
SELECT db_name, 'enable', 'scheduler', owner || '.' || job_name,
  'exec sys.dbms_scheduler.enable(''' || owner || '.' || job_name || ''')' FROM cat_scheduler_jobs WHERE enabled = 'TRUE'
UNION ALL
SELECT db_name, 'enable', 'job', CAST(job AS VARCHAR), 'exec sys.dbms_ijob.broken(' || CAST(job AS VARCHAR) || ', FALSE)'
FROM cat_jobs WHERE broken = 'N'""")
def q_job_toggle_plan(R):
    return ob.job_toggle_plan(R.scheduler_jobs, R.jobs)


@register("job_counts", """
SELECT db_name, coalesce(a.n, 0) AS scheduler_enabled, coalesce(b.n, 0) AS jobs_enabled
FROM (SELECT db_name, CAST(sum(CASE WHEN enabled = 'TRUE' THEN 1 ELSE 0 END) AS BIGINT) AS n FROM cat_scheduler_jobs GROUP BY db_name) a
FULL OUTER JOIN (SELECT db_name, CAST(sum(CASE WHEN broken = 'N' THEN 1 ELSE 0 END) AS BIGINT) AS n FROM cat_jobs GROUP BY db_name) b
USING (db_name)""")
def q_job_counts(R):
    return ob.job_counts(R.scheduler_jobs, R.jobs)


@register("decode_index_usage", """
SELECT ou.db_name, io.owner, io.name AS index_name, t.name AS table_name,
  CASE WHEN (i.flags & 65536) = 0 THEN 'NO' ELSE 'YES' END AS monitoring,
  CASE WHEN (ou.flags & 1) = 0 THEN 'NO' ELSE 'YES' END AS used, ou.start_monitoring, ou.end_monitoring
FROM cat_object_usage ou
JOIN cat_ind_flags i ON i.db_name = ou.db_name AND i.obj_id = ou.obj_id
JOIN cat_dict_objects io ON io.db_name = ou.db_name AND io.obj_id = ou.obj_id
JOIN cat_dict_objects t ON t.db_name = i.db_name AND t.obj_id = i.bo_id""")
def q_decode_index_usage(R):
    return ob.decode_index_usage(R.ind_flags, R.object_usage, R.dict_objects)


# Staged (MATERIALIZED) so no engine can join two catalog copies on
# db_name alone; each step joins on the full key.
_FK = """cr AS MATERIALIZED (
  SELECT c.db_name, c.owner, c.table_name, c.constraint_name, r.owner AS r_owner, r.constraint_name AS r_constraint_name
  FROM cat_constraints c
  JOIN cat_constraints r ON r.db_name = c.db_name AND r.owner = c.r_owner AND r.constraint_name = c.r_constraint_name
  WHERE c.constraint_type = 'R'),
crc AS MATERIALIZED (
  SELECT cr.*, cc.column_name, cc.position
  FROM cr JOIN cat_cons_columns cc ON cc.db_name = cr.db_name AND cc.owner = cr.owner AND cc.constraint_name = cr.constraint_name),
fk_cols AS MATERIALIZED (
  SELECT DISTINCT crc.db_name, crc.owner AS table_owner, crc.table_name, crc.column_name, crc.position
  FROM crc JOIN cat_cons_columns rc ON rc.db_name = crc.db_name AND rc.owner = crc.r_owner
    AND rc.constraint_name = crc.r_constraint_name AND rc.position = crc.position),
fk AS (
  SELECT DISTINCT ic.db_name, ic.index_owner AS owner, ic.index_name
  FROM cat_ind_columns ic JOIN fk_cols f ON f.db_name = ic.db_name AND f.table_owner = ic.table_owner
    AND f.table_name = ic.table_name AND f.column_name = ic.column_name AND f.position = ic.column_position)"""


@register("unmonitored_indexes", f"""
WITH {_FK}
SELECT DISTINCT i.db_name, i.owner, i.index_name, 'alter index ' || i.owner || '."' || i.index_name || '" monitoring usage;' AS remedy
FROM cat_indexes i
WHERE i.index_type IN ('NORMAL', 'BITMAP') AND i.uniqueness = 'NONUNIQUE' AND i.owner NOT IN (SELECT owner FROM cat_internal_owners)
  AND NOT EXISTS (SELECT 1 FROM cat_index_usage u WHERE u.db_name = i.db_name AND u.owner = i.owner AND u.index_name = i.index_name)
  AND NOT EXISTS (SELECT 1 FROM fk WHERE fk.db_name = i.db_name AND fk.owner = i.owner AND fk.index_name = i.index_name)""")
def q_unmonitored_indexes(R):
    return ob.unmonitored_indexes(R.indexes, R.index_usage, R.ind_columns, R.constraints, R.cons_columns,
                                  R.internal_owners)


@register("restart_monitoring", f"""
WITH {_FK}
SELECT DISTINCT u.db_name, u.owner, u.index_name, 'alter index ' || u.owner || '."' || u.index_name || '" monitoring usage;' AS remedy
FROM cat_index_usage u
WHERE u.monitoring = 'NO' AND u.owner NOT LIKE 'APEX%'
  AND NOT EXISTS (SELECT 1 FROM fk WHERE fk.db_name = u.db_name AND fk.owner = u.owner AND fk.index_name = u.index_name)""")
def q_restart_monitoring(R):
    return ob.restart_monitoring(R.index_usage, R.ind_columns, R.constraints, R.cons_columns)


@register("stop_monitoring", """
SELECT db_name, owner, index_name, 'alter index ' || owner || '."' || index_name || '" nomonitoring usage;' AS remedy
FROM cat_index_usage WHERE monitoring = 'YES' AND used = 'YES'""")
def q_stop_monitoring(R):
    return ob.stop_monitoring(R.index_usage)


@register("unused_indexes", """
SELECT db_name, owner, index_name, table_name, since,
  concat(owner, '.', index_name, ' on ', table_name, ' not used since ', strftime(since, '%m/%d/%y')) AS line
FROM (SELECT *, CAST(try_strptime(start_monitoring, '%m-%d-%Y %H:%M:%S') AS DATE) AS since FROM cat_index_usage) u
WHERE used = 'NO' AND monitoring = 'YES' AND owner NOT IN ('ENT_COMMON', 'GGS')""")
def q_unused_indexes(R):
    return ob.unused_indexes(R.index_usage)


@register("invisible_indexes", """
SELECT db_name, owner, index_name, table_name, owner || '.' || index_name || ' on ' || table_name AS line
FROM cat_indexes WHERE visibility = 'INVISIBLE'""")
def q_invisible_indexes(R):
    return ob.invisible_indexes(R.indexes)
