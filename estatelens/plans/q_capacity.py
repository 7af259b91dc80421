"""Registered capacity queries with their oracle SQL."""

from __future__ import annotations

from estatelens.operators import capacity as cap
from estatelens.plans.registry import register
from estatelens.sources.roles import EVENTS_AS_OF

_NOT_SYS = "tablespace_name NOT LIKE 'UNDO%' AND tablespace_name NOT LIKE 'SYS%'"
_STORAGE = "CASE WHEN substr(file_name, 1, 4) = '/u03' THEN 'ZFS' ELSE 'EXA' END"
_BLOCK_SIZE = "(SELECT db_name, TRY_CAST(value AS BIGINT) AS block_size FROM cat_parameters WHERE name = 'db_block_size')"
_HWM = "ceil(coalesce(h.hwm, 1) * b.block_size / 1048576)"
_RECLAIM = f"""
SELECT f.db_name, f.file_id, f.file_name, f.bytes / 1048576 AS real_size_mb,
  CAST({_HWM} + 9 AS BIGINT) AS shrunk_size_mb,
  f.bytes / 1048576 - ({_HWM} + 9) AS released_mb,
  'alter database datafile ''' || f.file_name || ''' resize ' || CAST(CAST({_HWM} + 9 AS BIGINT) AS VARCHAR) || ' m;' AS remedy
FROM cat_data_files f
LEFT JOIN (SELECT db_name, file_id, max(block_id + blocks - 1) AS hwm FROM cat_extents GROUP BY db_name, file_id) h
  ON h.db_name = f.db_name AND h.file_id = f.file_id
LEFT JOIN {_BLOCK_SIZE} b ON b.db_name = f.db_name
WHERE f.tablespace_name NOT LIKE 'UNDO%' AND f.tablespace_name NOT LIKE 'SYS%'
  AND ceil(f.blocks * b.block_size / 1048576) - {_HWM} > 10"""


@register("reclaimable_space", _RECLAIM)
def q_reclaimable_space(R):
    return cap.reclaimable_space(R.data_files, R.extents, R.parameters)


@register("tablespace_usage", """
SELECT a.db_name, a.tablespace_name AS tablespace, round(a.real_bytes / 1073741824, 1) AS realsize_gb,
  round(b.used_bytes / 1073741824, 1) AS used_gb, round((a.real_bytes - b.used_bytes) / 1073741824, 1) AS free_gb,
  round((a.real_bytes - b.used_bytes) / a.real_bytes * 100, 1) AS pct_free, a.storage, a.files
FROM (SELECT db_name, tablespace_name, sum(CASE WHEN autoextensible = 'YES' THEN maxbytes ELSE bytes END) AS real_bytes,
        max(""" + _STORAGE + """) AS storage, count(*) AS files
      FROM cat_data_files GROUP BY db_name, tablespace_name) a
JOIN (SELECT db_name, tablespace_name, sum(bytes) AS used_bytes FROM cat_extents GROUP BY db_name, tablespace_name) b
  ON a.db_name = b.db_name AND a.tablespace_name = b.tablespace_name""")
def q_tablespace_usage(R):
    return cap.tablespace_usage(R.data_files, R.extents)


@register("empty_tablespaces", f"""
SELECT db_name, tablespace_name, {_STORAGE} AS storage, count(*) AS files
FROM cat_data_files f
WHERE NOT EXISTS (SELECT 1 FROM cat_segments s WHERE s.db_name = f.db_name AND s.tablespace_name = f.tablespace_name)
GROUP BY db_name, tablespace_name, {_STORAGE}""")
def q_empty_tablespaces(R):
    return cap.empty_tablespaces(R.data_files, R.segments)


@register("datafile_total", f"""
SELECT d.db_name, t.mb AS datafile_size_mb, t.gb AS datafile_size_gb FROM (SELECT DISTINCT db_name FROM cat_databases) d LEFT JOIN (
  SELECT db_name, round(sum(bytes) / 1048576, 4) AS mb, round(sum(bytes) / 1073741824, 4) AS gb
  FROM cat_data_files WHERE {_NOT_SYS} GROUP BY db_name) t ON t.db_name = d.db_name""")
def q_datafile_total(R):
    return cap.datafile_total(R.data_files, R.databases)


@register("recyclebin_total", """
SELECT d.db_name, t.mb AS recoverable_mb, 'purge dba_recyclebin;' AS remedy FROM (SELECT DISTINCT db_name FROM cat_databases) d
LEFT JOIN (SELECT db_name, sum(space) / 128 AS mb FROM cat_recyclebin GROUP BY db_name) t ON t.db_name = d.db_name""")
def q_recyclebin_total(R):
    return cap.recyclebin_total(R.recyclebin, R.databases)


@register("autoextend_gaps", f"""
SELECT 'autoextend_gap' AS rule_id, db_name, CAST(NULL AS VARCHAR) AS owner, file_name AS object_name,
  'autoextensible=' || autoextensible || ' maxbytes=' || CAST(maxbytes AS VARCHAR) AS detail,
  'alter database datafile ''' || file_name || ''' autoextend on maxsize unlimited;' AS remedy
FROM cat_data_files WHERE (maxbytes < 34359721984 OR autoextensible = 'NO') AND {_NOT_SYS}""")
def q_autoextend_gaps(R):
    return cap.autoextend_gaps(R.data_files)


@register("small_increment", f"""
SELECT 'small_increment' AS rule_id, f.db_name, CAST(NULL AS VARCHAR) AS owner, f.file_name AS object_name,
  'next_mb=' || CAST(f.increment_by / 128 AS VARCHAR) AS detail,
  'alter database datafile ''' || f.file_name || ''' autoextend on next ' ||
    CASE WHEN b.block_size > 8192 THEN '20M' ELSE '10M' END || ';' AS remedy
FROM cat_data_files f LEFT JOIN {_BLOCK_SIZE} b ON b.db_name = f.db_name
WHERE f.increment_by < 1280 AND f.tablespace_name NOT LIKE 'UNDO%' AND f.tablespace_name NOT LIKE 'SYS%'""")
def q_small_increment(R):
    return cap.small_increment(R.data_files, R.parameters)


@register("size_delta", f"""
WITH plan AS ({_RECLAIM}),
after_files AS (
  SELECT f.db_name, CAST(coalesce(p.shrunk_size_mb * 1048576, f.bytes) AS BIGINT) AS bytes
  FROM cat_data_files f LEFT JOIN plan p ON p.db_name = f.db_name AND p.file_id = f.file_id WHERE {_NOT_SYS}),
b AS (SELECT db_name, sum(bytes) AS s FROM cat_data_files WHERE {_NOT_SYS} GROUP BY db_name),
a AS (SELECT db_name, sum(bytes) AS s FROM after_files GROUP BY db_name)
SELECT db_name, round(coalesce(b.s, 0) / 1048576, 4) AS before_mb, round(coalesce(a.s, 0) / 1048576, 4) AS after_mb,
  round((coalesce(b.s, 0) - coalesce(a.s, 0)) / 1048576, 4) AS recovered_mb
FROM b FULL OUTER JOIN a USING (db_name)""")
def q_size_delta(R):
    plan = cap.reclaimable_space(R.data_files, R.extents, R.parameters)
    files = cap.user_files(R.data_files)
    return cap.size_delta(files, cap.resized_files(files, plan))


@register("segment_footprint", """
WITH t AS (
  SELECT db_name, owner AS table_owner, segment_name AS table_name, bytes, 'Total Data Segments' AS kind
  FROM cat_segments WHERE segment_type LIKE 'TABLE%'
  UNION ALL
  SELECT s.db_name, i.table_owner, i.table_name, s.bytes, 'Total Index Segments'
  FROM cat_segments s JOIN (SELECT DISTINCT db_name, owner, index_name, table_owner, table_name FROM cat_indexes) i
    ON s.db_name = i.db_name AND s.owner = i.owner AND s.segment_name = i.index_name
  UNION ALL
  SELECT s.db_name, l.owner, l.table_name, s.bytes, 'Total LOB Segments'
  FROM cat_segments s JOIN (SELECT DISTINCT db_name, owner, segment_name, table_name FROM cat_lobs) l
    ON s.db_name = l.db_name AND s.owner = l.owner AND s.segment_name = l.segment_name
)
SELECT n.db_name, n.table_owner, n.table_name, k.kind, round(sum(t.bytes) / 1048576) AS mb, count(t.bytes) AS segments
FROM (SELECT DISTINCT db_name, table_owner, table_name FROM t) n
CROSS JOIN (VALUES ('Total Data Segments'), ('Total Index Segments'), ('Total LOB Segments')) AS k(kind)
LEFT JOIN t ON t.db_name = n.db_name AND t.table_owner = n.table_owner AND t.table_name = n.table_name AND t.kind = k.kind
GROUP BY n.db_name, n.table_owner, n.table_name, k.kind""")
def q_segment_footprint(R):
    return cap.segment_footprint(R.segments, R.indexes, R.lobs)


@register("top_lobs", """
SELECT db_name, lob_table, column_name, mb, CAST(rank AS INTEGER) AS rank FROM (
  SELECT db_name, owner || '.' || table_name AS lob_table, column_name, round(b / 1048576) AS mb,
    row_number() OVER (PARTITION BY db_name ORDER BY b DESC, owner, table_name, column_name) AS rank
  FROM (SELECT l.db_name, l.owner, l.table_name, l.column_name, sum(s.bytes) AS b
        FROM cat_lobs l JOIN cat_segments s ON s.db_name = l.db_name AND s.owner = l.owner AND s.segment_name = l.segment_name
        WHERE s.segment_type LIKE 'LOB%' GROUP BY l.db_name, l.owner, l.table_name, l.column_name) x
) y WHERE rank <= 10""")
def q_top_lobs(R):
    return cap.top_lobs(R.lobs, R.segments, n=10)


@register("storage_totals", """
SELECT db_name, 'datafiles' AS kind, round(sum(bytes) / 1073741824, 3) AS gb_used FROM cat_data_files GROUP BY db_name
UNION ALL SELECT db_name, 'tempfiles', round(sum(bytes) / 1073741824, 3) FROM cat_temp_files GROUP BY db_name
UNION ALL SELECT db_name, 'segments', round(sum(bytes) / 1073741824, 3) FROM cat_segments GROUP BY db_name
UNION ALL SELECT db_name, 'online redo logs', round(sum(bytes * members) / 1073741824, 3) FROM cat_redo GROUP BY db_name""")
def q_storage_totals(R):
    return cap.storage_totals(R.data_files, R.temp_files, R.segments, R.redo)


@register("temp_usage", """
SELECT db_name, tablespace, CAST(sum(blocks) AS BIGINT) AS total_blocks FROM cat_sort_usage GROUP BY db_name, tablespace""")
def q_temp_usage(R):
    return cap.temp_usage(R.sort_usage)


@register("misplaced_segments", """
SELECT db_name, problem, owner, tablespace_name, segment_type, count(*) AS cnt FROM (
  SELECT db_name, 'non-system object in system tablespace' AS problem, owner, tablespace_name, segment_type
  FROM cat_segments WHERE tablespace_name LIKE 'SYS%' AND owner NOT IN (SELECT owner FROM cat_internal_owners)
  UNION ALL
  SELECT s.db_name, 'system object in non-system tablespace', s.owner, s.tablespace_name, s.segment_type
  FROM cat_segments s
  WHERE s.tablespace_name NOT LIKE 'SYS%'
    AND EXISTS (SELECT 1 FROM cat_tablespaces t WHERE t.contents = 'PERMANENT' AND t.db_name = s.db_name AND t.tablespace_name = s.tablespace_name)
    AND s.owner IN (SELECT owner FROM cat_internal_owners)
) x GROUP BY db_name, problem, owner, tablespace_name, segment_type""")
def q_misplaced_segments(R):
    return cap.misplaced_segments(R.segments, R.tablespaces, R.internal_owners)


@register("parallel_degree", """
SELECT db_name, 'TABLE' AS object_type, owner, table_name, CAST(NULL AS VARCHAR) AS index_name, trim(degree) AS degree
FROM cat_tables WHERE (CASE WHEN trim(degree) = 'DEFAULT' THEN 1 ELSE TRY_CAST(trim(degree) AS INTEGER) END) > 1 AND owner NOT LIKE '%SYS%'
UNION ALL
SELECT db_name, 'INDEX', owner, table_name, index_name, trim(degree)
FROM cat_indexes WHERE (CASE WHEN trim(degree) = 'DEFAULT' THEN 1 ELSE TRY_CAST(trim(degree) AS INTEGER) END) > 1 AND owner NOT LIKE '%SYS%'""")
def q_parallel_degree(R):
    return cap.parallel_degree(R.tables, R.indexes)


@register("recovery_area_pct", """
SELECT db_name, round(space_used / space_limit * 100) AS pct_used,
  round((space_used - space_reclaimable) / space_limit * 100) AS pct_logical
FROM cat_recovery_dest""")
def q_recovery_area_pct(R):
    return cap.recovery_area_pct(R.recovery_dest)


_RATE = f"""(SELECT db_name, sum(blocks * block_size) / 6 AS rate FROM cat_archived_log
  WHERE deleted = 'NO' AND is_recovery_dest_file = 'YES' AND completion_time > TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 6 HOUR
  GROUP BY db_name)"""
_RUNWAY = f"""SELECT d.db_name, round(r.rate, 1) AS redo_bytes_per_hour,
  round((d.space_limit - d.space_used - d.space_reclaimable) / r.rate, 1) AS runway_hours
FROM cat_recovery_dest d LEFT JOIN {_RATE} r ON r.db_name = d.db_name"""


@register("redo_runway_hours", _RUNWAY)
def q_redo_runway_hours(R):
    return cap.redo_runway_hours(R.recovery_dest, R.archived_log, EVENTS_AS_OF)


_READINGS = f"""SELECT p.db_name, round(p.space_used / p.space_limit * 100) AS pct_used,
  round((p.space_used - p.space_reclaimable) / p.space_limit * 100) AS pct_logical, w.runway_hours,
  TIMESTAMP '{EVENTS_AS_OF}' AS reading_ts
FROM cat_recovery_dest p LEFT JOIN ({_RUNWAY}) w ON w.db_name = p.db_name"""


@register("current_readings", _READINGS)
def q_current_readings(R):
    return cap.latest_readings(R.recovery_dest, R.archived_log, EVENTS_AS_OF)


@register("threshold_alerts", f"""
SELECT db_name, pct_used, pct_logical, runway_hours, runway_hours / 24 AS runway_days
FROM ({_READINGS}) r WHERE pct_logical > 60""")
def q_threshold_alerts(R):
    return cap.threshold_alerts(cap.latest_readings(R.recovery_dest, R.archived_log, EVENTS_AS_OF), pct=60)


_DAILY = f"""daily AS (
  SELECT db_name, day, round(sum(credo) / 1048576) AS counter_mb FROM (
    SELECT db_name, CAST(begin_interval_time AS DATE) AS day, instance_number, max(value) AS credo
    FROM cat_sysstat
    WHERE begin_interval_time > TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 7 DAY AND stat_name = 'redo size'
    GROUP BY db_name, CAST(begin_interval_time AS DATE), instance_number) x
  GROUP BY db_name, day)"""


def _growth_sql(factor: int, col: str) -> str:
    return f"""WITH {_DAILY}
SELECT v1.db_name, CAST(round(avg(v1.counter_mb - v2.counter_mb)) * {8 * factor} AS BIGINT) AS {col}
FROM daily v1 JOIN daily v2 ON v1.db_name = v2.db_name AND v1.day = v2.day + 1
GROUP BY v1.db_name"""


@register("daily_counter_growth", _growth_sql(1, "estimate_mb"))
def q_daily_counter_growth(R):
    return cap.daily_counter_growth(R.sysstat, EVENTS_AS_OF, trend_days=7, num_days=8)


@register("required_free_space", _growth_sql(2, "required_mb"))
def q_required_free_space(R):
    return cap.required_free_space(R.sysstat, EVENTS_AS_OF, trend_days=7, num_days=8)


_FREE = """SELECT u.db_name, u.used_pct,
  CAST(round((100 - u.used_pct) * TRY_CAST(p.value AS BIGINT) / 1048576 / 100) AS BIGINT) AS free_mb
FROM (SELECT db_name, round(sum(percent_space_used) - sum(percent_space_reclaimable)) AS used_pct
      FROM cat_recovery_usage GROUP BY db_name) u
JOIN cat_parameters p ON p.db_name = u.db_name AND p.name = 'db_recovery_file_dest_size'"""


@register("recovery_area_free", _FREE)
def q_recovery_area_free(R):
    return cap.recovery_area_free(R.recovery_usage, R.parameters)


@register("sizing_verdict", f"""
WITH {_DAILY},
g AS (SELECT v1.db_name, CAST(round(avg(v1.counter_mb - v2.counter_mb)) * 8 AS BIGINT) AS estimate_mb,
        CAST(round(avg(v1.counter_mb - v2.counter_mb)) * 16 AS BIGINT) AS required_mb
      FROM daily v1 JOIN daily v2 ON v1.db_name = v2.db_name AND v1.day = v2.day + 1 GROUP BY v1.db_name),
f AS ({_FREE})
SELECT db_name, g.estimate_mb, g.required_mb, f.free_mb, f.free_mb >= g.required_mb AS sufficient
FROM g FULL OUTER JOIN f USING (db_name)""")
def q_sizing_verdict(R):
    return cap.sizing_verdict(
        cap.daily_counter_growth(R.sysstat, EVENTS_AS_OF),
        cap.recovery_area_free(R.recovery_usage, R.parameters))


@register("memory_stats", """
SELECT db_name, name, round(CASE WHEN unit = 'bytes' THEN value / 1048576 ELSE value END, 1) AS value,
  CASE WHEN unit = 'bytes' THEN 'mbytes' ELSE unit END AS unit
FROM cat_pgastat""")
def q_memory_stats(R):
    return cap.memory_stats(R.pgastat)


@register("memory_advice", """
SELECT db_name, CAST(trunc(pga_target_for_estimate / 1048576) AS BIGINT) AS target_mb,
  round(pga_target_factor * 100, 1) AS target_factor_pct,
  CAST(trunc(bytes_processed / 1048576) AS BIGINT) AS bytes_processed_mb,
  CAST(trunc(estd_extra_bytes_rw / 1048576) AS BIGINT) AS extra_bytes_rw_mb,
  round(estd_pga_cache_hit_percentage) AS cache_hit_pct, estd_overalloc_count AS overalloc_count
FROM cat_pga_advice""")
def q_memory_advice(R):
    return cap.memory_advice(R.pga_advice)


@register("license_cpus", """
SELECT db_name, TRY_CAST(value AS DOUBLE) / 4 AS license_cpus FROM cat_parameters WHERE name LIKE 'cpu_count'""")
def q_license_cpus(R):
    return cap.license_cpus(R.parameters)
