"""Registered source/sink and log queries.

Writers are exercised by writing below the session's checkpoint dir and
returning what was written, read back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from estatelens.operators import health as h
from estatelens.operators import inventory as inv
from estatelens.operators import logs as lg
from estatelens.plans.registry import register
from estatelens.sources import catalog as cat
from estatelens.sources import sinks
from estatelens.sources.roles import EVENTS_AS_OF
from estatelens.streaming import jobs

@register("scan_catalog", "SELECT * FROM cat_extents")
def q_scan_catalog(R):
    path = cat.scratch_path(R.spark, "catalog", "extents")
    cat.write_catalog(R.extents, path)
    return cat.scan_catalog(R.spark, path, "extents")


@register("fleet_union", "SELECT * FROM cat_data_files")
def q_fleet_union(R):
    """One folder per database, as collectors leave them, read as one table."""
    path = cat.scratch_path(R.spark, "fleet")
    cat.write_catalog(R.data_files, path)
    return cat.fleet_read(R.spark, path, R.data_files.drop("db_name").schema).select(*R.data_files.columns)


@register("fleet_select", """
SELECT f.* FROM cat_data_files f
WHERE f.db_name IN (SELECT db_name FROM cat_databases WHERE coalesce(database_role = 'PRIMARY', true))
  AND f.db_name NOT IN (SELECT db_name FROM cat_parameters WHERE name = 'clonedb' AND upper(value) = 'TRUE')""")
def q_fleet_select(R):
    return cat.fleet_select(R.data_files, R.databases, R.parameters)


@register("fleet_select_containers", """
SELECT c.* FROM cat_containers c JOIN cat_databases d ON d.db_name = c.db_name
WHERE d.database_role = 'PRIMARY' AND c.name NOT IN ('CDB$ROOT', 'PDB$SEED')""")
def q_fleet_select_containers(R):
    return cat.fleet_select(R.containers, R.databases, R.parameters, exclude_types=("standby",), container_col="name")


@register("database_status", """
SELECT c.db_name, c.name AS container, c.con_id, true AS exists, c.open_mode = 'READ WRITE' AS is_open_rw,
  coalesce(d.database_role <> 'PRIMARY', false) AS is_standby, coalesce(upper(p.value) = 'TRUE', false) AS is_clone
FROM cat_containers c LEFT JOIN cat_databases d ON d.db_name = c.db_name
LEFT JOIN (SELECT db_name, value FROM cat_parameters WHERE name = 'clonedb') p ON p.db_name = c.db_name""")
def q_database_status(R):
    return cat.database_status(R.containers, R.databases, R.parameters)


@register("parameter_value", """
SELECT db_name, TRY_CAST(value AS BIGINT) AS value FROM cat_parameters WHERE name = 'db_block_size'""")
def q_parameter_value(R):
    return cat.parameter_value(R.parameters, "db_block_size", "bigint")


@register("write_inventory", """
SELECT DISTINCT concat(owner, ',', table_name, ',', temporary) AS line, 'tables' AS kind, db_name FROM cat_tables
WHERE owner NOT LIKE 'APEX%' AND owner NOT IN (SELECT owner FROM cat_internal_owners)
UNION ALL
SELECT DISTINCT concat(owner, ',', view_name), 'views', db_name FROM cat_views
WHERE owner NOT LIKE 'APEX%' AND owner NOT IN (SELECT owner FROM cat_internal_owners)""")
def q_write_inventory(R):
    path = cat.scratch_path(R.spark, "inventory")
    sinks.write_inventory(inv.inv_tables(R.tables, R.internal_owners), "tables", path)
    sinks.write_inventory(inv.inv_views(R.views, R.internal_owners), "views", path)
    return sinks.read_inventory(R.spark, path)


@register("write_report", """
SELECT 'invalid_object' AS rule_id, owner, object_name, object_type || ' ' || owner || '.' || object_name AS detail,
  CAST(NULL AS VARCHAR) AS remedy, db_name, '20240131000000' AS run_ts
FROM cat_objects WHERE status <> 'VALID'""")
def q_write_report(R):
    path = cat.scratch_path(R.spark, "reports")
    f = h.invalid_objects(R.objects)
    sinks.write_report(f, path, "20240131000000")
    schema = ("rule_id string, owner string, object_name string, detail string, remedy string, "
              "db_name string, run_ts string")
    return R.spark.read.schema(schema).parquet(path)


_HIST = f"""WITH h AS (
  SELECT db_name, CAST(floor(epoch(completion_time) / 3600) AS BIGINT) AS hr, sum(blocks * block_size) AS b
  FROM cat_archived_log WHERE deleted = 'NO' AND is_recovery_dest_file = 'YES' GROUP BY 1, 2),
w AS (SELECT db_name, hr, sum(b) OVER (PARTITION BY db_name ORDER BY hr RANGE BETWEEN 5 PRECEDING AND CURRENT ROW) / 6 AS rate FROM h)
SELECT w.db_name, TIMESTAMP '1970-01-01 00:00:00' + to_seconds((w.hr + 1) * 3600) AS reading_ts,
  round(d.space_used / d.space_limit * 100) AS pct_used,
  round((d.space_used - d.space_reclaimable) / d.space_limit * 100) AS pct_logical,
  round(w.rate, 1) AS redo_bytes_per_hour,
  round((d.space_limit - d.space_used - d.space_reclaimable) / w.rate, 1) AS runway_hours
FROM w JOIN cat_recovery_dest d ON d.db_name = w.db_name"""


@register("redo_rate_history", _HIST)
def q_redo_rate_history(R):
    return lg.redo_rate_history(R.recovery_dest, R.archived_log)


@register("append_metrics", f"""
SELECT *, CAST(reading_ts AS DATE) AS dt FROM ({_HIST}) x""")
def q_append_metrics(R):
    path = cat.scratch_path(R.spark, "metrics")
    hist = lg.redo_rate_history(R.recovery_dest, R.archived_log)
    sinks.append_metrics(hist, path)
    return R.spark.read.schema(hist.schema.add("dt", "date")).parquet(path)


@register("latest_reading", f"""
SELECT db_name, max(reading_ts) AS reading_ts, arg_max(pct_used, reading_ts) AS pct_used,
  arg_max(pct_logical, reading_ts) AS pct_logical, arg_max(runway_hours, reading_ts) AS runway_hours,
  arg_max(runway_hours, reading_ts) / 24 AS runway_days
FROM ({_HIST}) x GROUP BY db_name""")
def q_latest_reading(R):
    return lg.latest_reading(lg.redo_rate_history(R.recovery_dest, R.archived_log))


_ARCHIVE = "SELECT line, db_name, strftime(ts, '%Y-%m') AS month FROM cat_log_lines"


@register("archive_logs_by_month", _ARCHIVE)
def q_archive_logs_by_month(R):
    path = cat.scratch_path(R.spark, "log_archive")
    lg.archive_logs_by_month(R.log_lines, path, compression="gzip")
    return lg.read_log_archive(R.spark, path)


@register("stream_archive_logs", _ARCHIVE)
def q_stream_archive_logs(R):
    spark = R.spark
    base = cat.scratch_path(spark, "stream_archive")
    in_dir, out, ckpt = f"{base}/in", f"{base}/out", f"{base}/checkpoint"
    (R.log_lines.select(jobs.format_log_line(F.col("db_name"), F.col("ts"), F.col("line")).alias("value"))
     .write.mode("overwrite").text(in_dir))
    q = jobs.stream_archive_logs(spark, in_dir, out, ckpt)
    q.awaitTermination()
    return lg.read_log_archive(spark, out)


@register("stream_redo_rate", """
WITH e AS (SELECT db_name, completion_time, blocks * block_size AS b FROM cat_archived_log
           WHERE deleted = 'NO' AND is_recovery_dest_file = 'YES'),
w AS (SELECT db_name, date_trunc('hour', completion_time) - INTERVAL 1 HOUR * r.k AS window_start, b
      FROM e CROSS JOIN range(0, 6) AS r(k))
SELECT x.*, round((d.space_limit - d.space_used - d.space_reclaimable) / x.redo_bytes_per_hour, 1) AS runway_hours
FROM (
  SELECT db_name, window_start, window_start + INTERVAL 6 HOUR AS window_end, CAST(sum(b) AS BIGINT) AS redo_bytes,
    sum(b) / 6 AS redo_bytes_per_hour
  FROM w GROUP BY db_name, window_start
  HAVING window_start + INTERVAL 6 HOUR <= (SELECT max(completion_time) FROM e) - INTERVAL 1 HOUR) x
LEFT JOIN cat_recovery_dest d ON d.db_name = x.db_name""")
def q_stream_redo_rate(R):
    spark = R.spark
    base = cat.scratch_path(spark, "stream_redo")
    in_dir, out, ckpt = f"{base}/in", f"{base}/out", f"{base}/checkpoint"
    R.archived_log.select(*[f.name for f in jobs.ARCHIVED_LOG_SCHEMA.fields]).write.mode("overwrite").parquet(in_dir)
    q = jobs.stream_redo_rate(spark, in_dir, out, ckpt, recovery_dest=R.recovery_dest)
    q.awaitTermination()
    return spark.read.parquet(out)


@register("file_retention_plan", rf"""
SELECT db_name, path, size_bytes, mtime, action, rule FROM (
  SELECT *, (epoch_us(TIMESTAMP '{EVENTS_AS_OF}') - epoch_us(mtime)) / 60000000.0 AS age_min FROM cat_files) f,
  LATERAL (SELECT CASE
    WHEN NOT is_dir AND regexp_matches(path, '/listener/.*/log[^/]*\.xml[^/]*$') AND floor(age_min / 1440) > 1 THEN 1
    WHEN NOT is_dir AND regexp_matches(path, '/listener/.*/log[^/]*\.xml$') THEN 2
    WHEN NOT is_dir AND regexp_matches(path, '/listener[^/]*$') AND floor(age_min / 1440) > 30 THEN 3
    WHEN NOT is_dir AND ends_with(path, '.aud') THEN 4
    WHEN NOT is_dir AND ends_with(path, '.trc') AND size_bytes = 0 AND age_min > 360 THEN 5
    WHEN NOT is_dir AND ends_with(path, '.trm') AND size_bytes = 0 AND age_min > 360 THEN 6
    WHEN NOT is_dir AND ends_with(path, '.trc') AND size_bytes > 0 AND age_min > 10 THEN 7
    WHEN NOT is_dir AND ends_with(path, '.trm') AND size_bytes > 0 AND age_min > 10 THEN 8
    WHEN NOT is_dir AND ends_with(path, '.xml') AND floor(age_min / 1440) > 30 THEN 9
    WHEN NOT is_dir AND ends_with(path, '.xml') AND floor(age_min / 1440) > 0 THEN 10
    WHEN NOT is_dir AND ends_with(path, '.tgz') AND floor(age_min / 1440) > 30 THEN 11 END AS rule) r,
  LATERAL (SELECT CASE WHEN rule IN (1, 3, 4, 5, 6, 9, 11) THEN 'delete' WHEN rule IN (2, 7, 8, 10) THEN 'truncate' END AS action) a
WHERE rule IS NOT NULL""")
def q_file_retention_plan(R):
    return lg.file_retention_plan(R.files, EVENTS_AS_OF)
