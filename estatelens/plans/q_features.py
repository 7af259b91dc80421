"""Registered feature-usage queries with their oracle SQL.

The option map is a fixed constant; its registered query reports it
together with how many databases of the fleet report each feature.
"""

from __future__ import annotations

from estatelens.operators import features as fe
from estatelens.plans.registry import register
from estatelens.sources.roles import EVENTS_AS_OF


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_MAP = "(VALUES " + ", ".join(f"({_q(o)}, {_q(n)})" for o, n in fe.OPTION_FEATURES) + ") AS m(option_name, name)"
_DP = "('Oracle Utility Datapump (Export)', 'Oracle Utility Datapump (Import)')"
_PRED = f"""(f.detected_usages > 0 AND f.last_usage_date > TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 366 DAY AND f.total_samples > 0
  AND (f.name NOT IN ('Data Guard', 'Oracle Utility Datapump (Export)', 'Oracle Utility Datapump (Import)')
    OR (f.name = 'Data Guard' AND f.feature_info IS NOT NULL
        AND trim(substr(f.feature_info, instr(f.feature_info, 'Compression used: ') + 18, 5)) <> 'FALSE')
    OR (f.name IN {_DP} AND f.feature_info IS NOT NULL AND trim(CAST(NULL AS VARCHAR)) <> '0')))"""
_INFO = """(SELECT d.db_name, d.dbid, d.name AS database_name, i.version AS db_version, i.host_name
  FROM cat_databases d LEFT JOIN cat_instance i ON i.db_name = d.db_name)"""


@register("option_usage_summary", f"""
WITH used AS (
  SELECT f.db_name, m.option_name, max(CASE WHEN {_PRED} THEN 1 ELSE 0 END) AS num
  FROM cat_feature_usage f JOIN {_MAP} ON m.name = f.name GROUP BY f.db_name, m.option_name),
opts AS (SELECT DISTINCT option_name FROM {_MAP}),
universe AS (SELECT d.db_name, o.option_name FROM cat_databases d CROSS JOIN opts o)
SELECT u.db_name, u.option_name, CASE WHEN coalesce(x.num, 0) > 0 THEN 'YES' ELSE 'NO' END AS used,
  info.dbid, info.database_name, info.db_version, info.host_name
FROM universe u
LEFT JOIN used x ON x.db_name = u.db_name AND x.option_name = u.option_name
LEFT JOIN {_INFO} info ON info.db_name = u.db_name""")
def q_option_usage_summary(R):
    return fe.option_usage_summary(R.feature_usage, R.instance, R.databases, EVENTS_AS_OF)


@register("option_usage_detail", f"""
SELECT f.db_name, m.option_name, 'YES' AS used,
  CASE WHEN f.name IN {_DP} THEN 'Data Pump Compression' WHEN f.name = 'Data Guard' THEN 'Data Guard Network Compression'
       ELSE f.name END AS feature,
  f.version, f.currently_used, f.detected_usages, f.last_usage_date, f.total_samples, f.last_sample_date,
  info.dbid, info.database_name, info.db_version, info.host_name,
  strftime(TIMESTAMP '{EVENTS_AS_OF}', '%Y-%m-%d %H:%M:%S') AS report_time
FROM cat_feature_usage f JOIN {_MAP} ON m.name = f.name JOIN {_INFO} info ON info.db_name = f.db_name
WHERE {_PRED}""")
def q_option_usage_detail(R):
    return fe.option_usage_detail(R.feature_usage, R.instance, R.databases, EVENTS_AS_OF)


@register("option_feature_map", f"""
SELECT m.option_name, m.name, coalesce(s.n, 0) AS reporting_databases
FROM {_MAP} LEFT JOIN (SELECT name, count(DISTINCT db_name) AS n FROM cat_feature_usage GROUP BY name) s ON s.name = m.name""")
def q_option_feature_map(R):
    return fe.option_map_coverage(R.feature_usage)
