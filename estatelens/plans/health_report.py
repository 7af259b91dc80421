"""All findings of every database in one result.

Each rule is an independent DataFrame over shared catalog roles; the report
is one ``unionByName`` and therefore one action. Each rule scans the roles it
needs with its own columns and filters; equal exchanges are reused, scans are
not.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.functions.findings import finding
from estatelens.operators import health as h
from estatelens.operators import security as sec
from estatelens.plans import q_security  # noqa: F401  (registers the security finding SQL)
from estatelens.plans.q_health import FINDING_SQL
from estatelens.plans.q_security import PROFILE
from estatelens.plans.registry import register
from estatelens.sources.roles import ORDERS_AS_OF

# Rules in report order (structure, dictionary, triggers, accounts, grants).
REPORT_RULES = [
    "restore_points", "registry_problems", "index_owner_mismatch", "deprecated_type_columns",
    "unusable_indexes", "nonunique_index_on_key", "chained_synonyms", "invalid_synonyms",
    "missing_sequence_grants", "missing_grant_option", "excessive_grants", "stale_table_stats",
    "leftover_jobs", "stale_dependents", "dependency_mismatch", "broken_triggers",
    "trigger_owner_mismatch", "disabled_triggers", "default_passwords", "wrong_temp_tablespace",
    "missing_quota", "acl_check", "password_needs_change", "aged_passwords", "elevated_privileges", "config_parameters",
]

# Sections that are lists of their own elsewhere, as findings.
SECTION_SQL = {
    "acl_check": """SELECT 'acl_check' AS rule_id, d.db_name, CAST(NULL AS VARCHAR) AS owner, '*' AS object_name,
  CASE WHEN coalesce(w.n, 0) = 1 THEN 'ACL OK' ELSE 'ACL Error' END AS detail, CAST(NULL AS VARCHAR) AS remedy
FROM (SELECT DISTINCT db_name FROM cat_databases) d
LEFT JOIN (SELECT db_name, count(*) AS n FROM cat_network_acls WHERE host = '*' GROUP BY db_name) w ON w.db_name = d.db_name""",
    "password_needs_change": f"""SELECT 'password_needs_change' AS rule_id, db_name, username AS owner, username AS object_name, account_status AS detail,
  CAST(NULL AS VARCHAR) AS remedy
FROM (SELECT DISTINCT u.db_name, u.username, u.profile, u.account_status
      FROM cat_users u LEFT JOIN cat_user_history h ON h.db_name = u.db_name AND h.user_id = u.user_id
      WHERE u.profile = '{PROFILE}' AND (h.password_date IS NULL OR u.account_status NOT IN ('OPEN'))) x""",
    "aged_passwords": f"""SELECT 'aged_password' AS rule_id, db_name, name AS owner, name AS object_name, strftime(ptime, '%Y-%m-%d') AS detail,
  CAST(NULL AS VARCHAR) AS remedy
FROM cat_user_base WHERE astatus = 0 AND type_id = 1 AND ptime < TIMESTAMP '{ORDERS_AS_OF}' - INTERVAL 90 DAY""",
    "elevated_privileges": """SELECT 'elevated_privilege' AS rule_id, db_name, grantee AS owner, grantee AS object_name, privilege AS detail, CAST(NULL AS VARCHAR) AS remedy
FROM (SELECT db_name, 'SYSDBA' AS privilege, username AS grantee FROM cat_pwfile_users WHERE username <> 'SYS'
      UNION ALL SELECT db_name, 'DBA', grantee FROM cat_role_privs WHERE granted_role = 'DBA' AND grantee NOT LIKE 'SYS%') x""",
    "config_parameters": """SELECT 'replication_setting' AS rule_id, db_name, CAST(NULL AS VARCHAR) AS owner, name AS object_name, value AS detail, CAST(NULL AS VARCHAR) AS remedy
FROM cat_parameters WHERE value IS NOT NULL AND (
  ((name LIKE 'log_archive_%' OR name LIKE 'fal%' OR name LIKE 'db%name') AND name NOT LIKE 'log_archive_dest_state%')
  OR (name LIKE 'log_archive_dest_state%' AND upper(value) <> 'ENABLE'))""",
}


def health_report(R, as_of: str = ORDERS_AS_OF, profile: str = PROFILE) -> DataFrame:
    rules = {
        "restore_points": lambda: h.restore_points(R.restore_points),
        "registry_problems": lambda: h.registry_problems(R.registry),
        "index_owner_mismatch": lambda: h.index_owner_mismatch(R.indexes),
        "deprecated_type_columns": lambda: h.deprecated_type_columns(R.columns, R.internal_owners),
        "unusable_indexes": lambda: h.unusable_indexes(R.indexes, R.ind_partitions, ordered=False),
        "nonunique_index_on_key": lambda: h.nonunique_index_on_key(R.constraints, R.indexes),
        "chained_synonyms": lambda: h.chained_synonyms(R.synonyms),
        "invalid_synonyms": lambda: h.invalid_synonyms(R.objects),
        "missing_sequence_grants": lambda: sec.missing_sequence_grants(R.columns, R.tab_privs),
        "missing_grant_option": lambda: sec.missing_grant_option(R.dependencies, R.tab_privs, R.objects,
                                                                 R.internal_owners),
        "excessive_grants": lambda: sec.excessive_grants(R.tab_privs, R.users, R.internal_owners, ordered=False),
        "stale_table_stats": lambda: h.stale_table_stats(R.tables, R.tab_stats, R.externals, as_of, ordered=False),
        "leftover_jobs": lambda: h.leftover_jobs(R.datapump_jobs, R.objects),
        "stale_dependents": lambda: h.stale_dependents(R.objects, R.obj_dict, R.obj_dependency),
        "dependency_mismatch": lambda: h.dependency_mismatch(R.objects, R.obj_dict, R.obj_dependency),
        "broken_triggers": lambda: h.broken_triggers(R.triggers, R.objects),
        "trigger_owner_mismatch": lambda: h.trigger_owner_mismatch(R.triggers),
        "disabled_triggers": lambda: h.disabled_triggers(R.triggers, R.internal_owners),
        "default_passwords": lambda: sec.default_passwords(R.users_defpwd),
        "wrong_temp_tablespace": lambda: sec.wrong_temp_tablespace(R.users, R.db_properties),
        "missing_quota": lambda: sec.missing_quota(R.segments, R.sys_privs, R.ts_quotas),
        "acl_check": lambda: finding(h.acl_check(R.databases, R.network_acls), "acl_check", object_name=F.lit("*"), detail="status"),
        "password_needs_change": lambda: finding(sec.password_needs_change(R.users, R.user_history, profile), "password_needs_change",
                                                 owner="username", object_name="username", detail="account_status"),
        "aged_passwords": lambda: finding(sec.aged_passwords(R.user_base, as_of), "aged_password", owner="name", object_name="name",
                                          detail=F.date_format("last_password_change", "yyyy-MM-dd")),
        "elevated_privileges": lambda: finding(sec.elevated_privileges(R.pwfile_users, R.role_privs), "elevated_privilege",
                                               owner="grantee", object_name="grantee", detail="privilege"),
        "config_parameters": lambda: finding(h.config_parameters(R.parameters), "replication_setting", object_name="name", detail="value"),
    }
    # the report is a set of findings: rules skip their presentation sort
    return reduce(DataFrame.unionByName, [rules[k]() for k in REPORT_RULES])


def _report_sql() -> str:
    return "\nUNION ALL\n".join(f"SELECT * FROM ({SECTION_SQL.get(k) or FINDING_SQL[k]}) r{i}" for i, k in enumerate(REPORT_RULES))


@register("health_report", _report_sql())
def q_health_report(R):
    return health_report(R)
