"""Registered queries over subtotals, sketches, fleet-wide sets, grant lists and parsed details."""

from __future__ import annotations

from pyspark.sql import functions as F

from estatelens.operators import rollups as ru
from estatelens.plans.registry import register
from estatelens.sources import catalog as cat


@register("space_rollup", """
SELECT db_name, tablespace_name, owner, segment_type, grouping(db_name, tablespace_name, owner, segment_type) AS grouping, CAST(sum(bytes) AS BIGINT) AS bytes, count(*) AS segments
FROM cat_segments GROUP BY GROUPING SETS ((db_name, tablespace_name, owner, segment_type), (db_name, tablespace_name, owner), (db_name, tablespace_name), (db_name, owner), (db_name), ())""")
def q_space_rollup(R):
    return ru.space_rollup(R.segments)


@register("sketch_accuracy", """
WITH e AS (SELECT db_name, recid % 997 AS item, CAST(blocks AS DOUBLE) AS size, CAST(completion_time AS DATE) AS day FROM cat_archived_log)
SELECT db_name, count(*) AS n, count(DISTINCT day) AS days, count(DISTINCT item) AS exact_items, true AS items_within, true AS median_within, true AS merge_is_union FROM e GROUP BY db_name""")
def q_sketch_accuracy(R):
    """Daily sketches are written, merged from the files and held against exact counts and against the sketch of all rows."""
    item, size, by = F.col("recid") % 997, F.col("blocks"), ["db_name"]
    path = cat.scratch_path(R.spark, "sketches")
    daily = ru.daily_sketches(R.archived_log, "completion_time", item, size)
    daily.write.partitionBy("day").parquet(path)
    stored = R.spark.read.schema(daily.schema).parquet(path)
    merged = ru.sketch_estimates(ru.merge_sketches(stored), (0.5,))
    days = stored.groupBy("db_name").agg(F.count(F.lit(1)).alias("days"))
    direct = R.archived_log.groupBy("db_name").agg(F.hll_sketch_estimate(F.hll_sketch_agg(item, ru.HLL_BITS)).alias("direct"), F.count_distinct(item).alias("exact_items"))
    near = F.abs(F.col("distinct_items") - F.col("exact_items")) <= 0.05 * F.col("exact_items")
    all_of = merged.join(days, by).join(direct, by)
    median = R.archived_log.join(F.broadcast(merged.select("db_name", F.col("quantiles")[0].alias("m"))), by)
    ranks = median.groupBy("db_name").agg((F.avg((F.col("blocks") < F.col("m")).cast("double")) <= 0.53).alias("low"), (F.avg((F.col("blocks") <= F.col("m")).cast("double")) >= 0.47).alias("high"))
    return all_of.join(ranks, by).select("db_name", "n", "days", "exact_items", near.alias("items_within"), (F.col("low") & F.col("high")).alias("median_within"),
                                         (F.abs(F.col("direct") - F.col("distinct_items")) <= 0.02 * F.col("direct")).alias("merge_is_union"))


@register("grant_lines", """
SELECT db_name, 'grant ' || string_agg(DISTINCT privilege, ',' ORDER BY privilege) || ' on ' || owner || '.' || table_name || ' to ' || grantee ||
  CASE grantable WHEN 'YES' THEN ' with grant option;' ELSE ';' END AS line
FROM cat_tab_privs WHERE owner NOT LIKE 'APEX%' AND owner NOT IN (SELECT owner FROM cat_internal_owners)
GROUP BY db_name, owner, table_name, grantee, grantable""")
def q_grant_lines(R):
    return ru.grant_lines(R.tab_privs, R.internal_owners)


@register("grants_in_every_database", """
SELECT grantee, privilege, grantable FROM cat_tab_privs WHERE db_name IN (SELECT db_name FROM cat_databases)
GROUP BY 1, 2, 3 HAVING count(DISTINCT db_name) = (SELECT count(DISTINCT db_name) FROM cat_databases)""")
def q_grants_in_every_database(R):
    return ru.in_every_database(R.tab_privs, ["grantee", "privilege", "grantable"], R.databases)


@register("orphaned_synonyms", """
SELECT 'orphaned_synonym' AS rule_id, s.db_name, s.owner, s.synonym_name AS object_name, s.table_owner || '.' || s.table_name AS detail,
  'drop synonym ' || s.owner || '.' || s.synonym_name || ';' AS remedy
FROM cat_synonyms s LEFT JOIN (SELECT DISTINCT db_name, owner, table_name FROM cat_tab_privs) t
  ON t.db_name = s.db_name AND t.owner = s.table_owner AND t.table_name = s.table_name
WHERE t.table_name IS NULL AND s.owner NOT IN ('PUBLIC', 'APEX_LISTENER', 'SYS', 'SYSTEM')""")
def q_orphaned_synonyms(R):
    return ru.orphaned_synonyms(R.synonyms, R.tab_privs)


@register("event_details", """
WITH t AS (SELECT db_name, event_id, trim(info) AS info FROM cat_event_details WHERE trim(info) <> ''),
j AS (SELECT db_name, event_id, 'json' AS source, unnest(json_keys(info)) AS name, info FROM t WHERE starts_with(info, '{') AND json_valid(info)),
p AS (SELECT db_name, event_id, unnest(regexp_extract_all(info, '[A-Za-z][A-Za-z0-9_ ]*?\\s*[:=]\\s*[^,;]+')) AS pair FROM t WHERE NOT starts_with(info, '{')),
d AS (
  SELECT db_name, event_id, source, name, json_extract_string(info, '$."' || name || '"') AS value, CAST(NULL AS VARCHAR) AS bad_record FROM j
  UNION ALL SELECT db_name, event_id, 'pairs', trim(split_part(pair, ':', 1)), trim(split_part(pair, ':', 2)), NULL FROM p
  UNION ALL SELECT db_name, event_id, 'bad', NULL, NULL, info FROM t
    WHERE CASE WHEN starts_with(info, '{') THEN NOT json_valid(info) ELSE NOT regexp_matches(info, '[A-Za-z][A-Za-z0-9_ ]*?\\s*[:=]\\s*[^,;]+') END)
SELECT db_name, event_id, source, name, value, TRY_CAST(value AS BIGINT) AS number,
  CASE WHEN lower(value) IN ('true', 'yes') THEN true WHEN lower(value) IN ('false', 'no') THEN false END AS flag, bad_record FROM d""")
def q_event_details(R):
    return ru.parsed_details(R.event_details, "info", ["db_name", "event_id"])
