"""Registered queries over the edition hierarchy."""

from __future__ import annotations

from estatelens.operators import editions as ed
from estatelens.plans.registry import register

# level from the base; what hangs on an end other than the base is detached, the rest on a cycle
_LEVELS = """RECURSIVE down AS (
  SELECT db_name, edition_name, CAST(1 AS BIGINT) AS level FROM cat_editions WHERE edition_name = 'ORA$BASE' AND parent_edition_name IS NULL
  UNION ALL SELECT e.db_name, e.edition_name, d.level + 1 FROM cat_editions e JOIN down d ON e.db_name = d.db_name AND e.parent_edition_name = d.edition_name),
lost AS (
  SELECT e.db_name, e.edition_name FROM cat_editions e LEFT JOIN cat_editions p ON p.db_name = e.db_name AND p.edition_name = e.parent_edition_name
  WHERE p.edition_name IS NULL AND e.edition_name <> 'ORA$BASE'
  UNION ALL SELECT e.db_name, e.edition_name FROM cat_editions e JOIN lost l ON e.db_name = l.db_name AND e.parent_edition_name = l.edition_name),
levels AS (
  SELECT e.db_name, e.edition_name, e.parent_edition_name, d.level,
    CASE WHEN d.level IS NOT NULL THEN 'deployed' WHEN l.edition_name IS NOT NULL THEN 'detached' ELSE 'cycle' END AS state
  FROM cat_editions e LEFT JOIN down d ON d.db_name = e.db_name AND d.edition_name = e.edition_name
  LEFT JOIN lost l ON l.db_name = e.db_name AND l.edition_name = e.edition_name)"""


@register("edition_order", f"""WITH {_LEVELS}
SELECT v.db_name, v.edition_name, v.parent_edition_name, v.level,
  CASE WHEN state = 'deployed' THEN row_number() OVER (PARTITION BY v.db_name, state ORDER BY v.level, v.edition_name) END AS deploy_order,
  EXISTS (SELECT 1 FROM cat_edition_privs p WHERE p.db_name = v.db_name AND p.table_name = v.edition_name AND p.privilege = 'USE') AS usable, v.state
FROM levels v""")
def q_edition_order(R):
    return ed.edition_order(R.editions, R.edition_privs)


@register("edition_object_counts", f"""WITH {_LEVELS}
SELECT o.db_name, o.edition_name, c.comments, o.status, max(o.created) AS last_deploy, count(*) AS objects, max(v.level) AS deploy_order
FROM cat_edition_objects o JOIN levels v ON v.db_name = o.db_name AND v.edition_name = o.edition_name AND v.state = 'deployed'
JOIN cat_edition_comments c ON c.db_name = o.db_name AND c.edition_name = o.edition_name
WHERE o.object_type NOT IN ('SYNONYM') GROUP BY o.db_name, o.edition_name, c.comments, o.status""")
def q_edition_object_counts(R):
    return ed.edition_object_counts(R.edition_objects, R.edition_comments, R.editions)


@register("service_editions", """
SELECT db_name, 'Service ' || name || ' Edition ' || coalesce(edition, '(default)') AS line FROM cat_services
WHERE name NOT LIKE 'SYS%' AND name NOT LIKE '%XDB'""")
def q_service_editions(R):
    return ed.service_editions(R.services)
