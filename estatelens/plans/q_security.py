"""Registered security queries with their oracle SQL."""

from __future__ import annotations

from estatelens.operators import security as sec
from estatelens.plans.q_health import FINDING_SQL
from estatelens.plans.registry import register
from estatelens.sources.roles import ORDERS_AS_OF

N = "CAST(NULL AS VARCHAR)"
PROFILE = "BUILDING"


def _finding(key, sql):
    FINDING_SQL[key] = sql
    return register(key, sql)


@_finding("missing_sequence_grants", r"""
WITH x AS MATERIALIZED (
  SELECT db_name, owner, table_name,
    CASE WHEN instr(trim(lower(data_default)), '.') > 0 THEN regexp_extract(trim(lower(data_default)), '^(.*)\.[^.]*$', 1) END AS seq
  FROM cat_columns WHERE data_default IS NOT NULL AND trim(lower(data_default)) LIKE '%nextval%'),
s AS MATERIALIZED (
  SELECT DISTINCT db_name, owner, table_name,
    CASE WHEN instr(seq, '.') > 0 THEN replace(upper(split_part(seq, '.', 1)), '"', '') ELSE 'unknown' END AS seq_schema,
    CASE WHEN instr(seq, '.') > 0 THEN replace(upper(substr(seq, instr(seq, '.') + 1)), '"', '') ELSE seq END AS seq_name
  FROM x),
ins AS MATERIALIZED (SELECT DISTINCT db_name, owner, table_name, grantee FROM cat_tab_privs WHERE privilege = 'INSERT'),
sel AS MATERIALIZED (SELECT DISTINCT db_name, owner, table_name, grantee FROM cat_tab_privs WHERE privilege = 'SELECT'),
need AS MATERIALIZED (
  SELECT DISTINCT s.db_name, s.seq_schema, s.seq_name, p.grantee
  FROM s JOIN ins p ON p.db_name = s.db_name AND p.owner = s.owner AND p.table_name = s.table_name)
SELECT 'missing_sequence_grant' AS rule_id, db_name, seq_schema AS owner, seq_name AS object_name, grantee AS detail,
  concat('grant select on ', seq_schema, '.', seq_name, ' to ', grantee, ';') AS remedy
FROM need n ANTI JOIN sel p ON p.db_name = n.db_name AND p.owner = n.seq_schema AND p.table_name = n.seq_name AND p.grantee = n.grantee""")
def q_missing_sequence_grants(R):
    return sec.missing_sequence_grants(R.columns, R.tab_privs)


@_finding("missing_grant_option", f"""
SELECT DISTINCT 'missing_grant_option' AS rule_id, d.db_name, d.owner, d.referenced_name AS object_name, {N} AS detail,
  'grant select on ' || d.referenced_owner || '.' || d.referenced_name || ' to ' || d.owner || ' with grant option;' AS remedy
FROM cat_dependencies d
WHERE d.referenced_owner <> d.owner AND d.type = 'VIEW' AND d.referenced_type = 'TABLE' AND d.owner NOT LIKE 'APEX%'
  AND d.owner NOT IN (SELECT owner FROM cat_internal_owners)
  AND EXISTS (SELECT 1 FROM cat_tab_privs p JOIN cat_objects o
                ON o.db_name = p.db_name AND o.owner = p.owner AND o.object_name = p.table_name AND o.object_type = 'VIEW'
              WHERE p.privilege = 'SELECT' AND p.db_name = d.db_name AND p.owner = d.owner AND p.table_name = d.name)
  AND NOT EXISTS (SELECT 1 FROM cat_tab_privs g WHERE g.privilege = 'SELECT' AND g.grantable = 'YES' AND g.db_name = d.db_name
                  AND g.owner = d.referenced_owner AND g.table_name = d.referenced_name AND g.grantee = d.owner)""")
def q_missing_grant_option(R):
    return sec.missing_grant_option(R.dependencies, R.tab_privs, R.objects, R.internal_owners)


@_finding("excessive_grants", """
SELECT 'excessive_grant' AS rule_id, p.db_name, p.owner, p.table_name AS object_name, p.privilege || ' to ' || p.grantee AS detail,
  'revoke ' || p.privilege || ' on ' || p.owner || '."' || p.table_name || '" from ' || p.grantee || ';' AS remedy
FROM cat_tab_privs p
WHERE p.grantee <> p.owner AND p.grantee NOT LIKE 'APEX%'
  AND p.privilege IN ('ON COMMIT REFRESH', 'FLASHBACK', 'QUERY REWRITE', 'INDEX', 'DEBUG', 'ALTER')
  AND p.grantee NOT IN (SELECT owner FROM cat_internal_owners) AND p.owner NOT IN (SELECT owner FROM cat_internal_owners)
  AND EXISTS (SELECT 1 FROM cat_users u WHERE u.db_name = p.db_name AND u.username = p.owner)""")
def q_excessive_grants(R):
    return sec.excessive_grants(R.tab_privs, R.users, R.internal_owners)


@register("password_needs_change", f"""
SELECT u.db_name, u.username, u.profile, u.account_status, max(h.password_date) AS last_change
FROM cat_users u LEFT JOIN cat_user_history h ON h.db_name = u.db_name AND h.user_id = u.user_id
WHERE u.profile = '{PROFILE}' AND (h.password_date IS NULL OR u.account_status NOT IN ('OPEN'))
GROUP BY u.db_name, u.username, u.profile, u.account_status""")
def q_password_needs_change(R):
    return sec.password_needs_change(R.users, R.user_history, PROFILE)


@_finding("default_passwords", f"""
SELECT 'default_password' AS rule_id, db_name, username AS owner, username AS object_name, {N} AS detail,
  '-- ' || username || ' has default password!' || chr(10) || 'alter user ' || username || ' identified by "<new password>";' AS remedy
FROM cat_users_defpwd WHERE username NOT IN ('XS$NULL')""")
def q_default_passwords(R):
    return sec.default_passwords(R.users_defpwd)


@_finding("wrong_temp_tablespace", """
SELECT 'wrong_temp_tablespace' AS rule_id, u.db_name, u.username AS owner, u.username AS object_name, u.temporary_tablespace AS detail,
  'alter user ' || u.username || ' temporary tablespace ' || p.property_value || ';' AS remedy
FROM cat_users u JOIN cat_db_properties p ON p.db_name = u.db_name AND p.property_name = 'DEFAULT_TEMP_TABLESPACE'
WHERE u.temporary_tablespace <> p.property_value""")
def q_wrong_temp_tablespace(R):
    return sec.wrong_temp_tablespace(R.users, R.db_properties)


@register("aged_passwords", f"""
SELECT db_name, name, ptime AS last_password_change, resource AS profile FROM cat_user_base
WHERE astatus = 0 AND type_id = 1 AND ptime < TIMESTAMP '{ORDERS_AS_OF}' - INTERVAL 90 DAY""")
def q_aged_passwords(R):
    return sec.aged_passwords(R.user_base, ORDERS_AS_OF, days=90)


@register("elevated_privileges", """
SELECT db_name, 'SYSDBA' AS privilege, username AS grantee FROM cat_pwfile_users WHERE username <> 'SYS'
UNION ALL
SELECT db_name, 'DBA', grantee FROM cat_role_privs WHERE granted_role = 'DBA' AND grantee NOT LIKE 'SYS%'""")
def q_elevated_privileges(R):
    return sec.elevated_privileges(R.pwfile_users, R.role_privs)


@_finding("missing_quota", f"""
SELECT 'missing_quota' AS rule_id, s.db_name, s.owner, s.tablespace_name AS object_name, {N} AS detail,
  'alter user ' || s.owner || ' quota unlimited on ' || s.tablespace_name || ';' AS remedy
FROM (SELECT DISTINCT db_name, owner, tablespace_name FROM cat_segments) s
WHERE NOT EXISTS (SELECT 1 FROM cat_sys_privs p WHERE p.privilege = 'UNLIMITED TABLESPACE' AND p.db_name = s.db_name AND p.grantee = s.owner)
  AND NOT EXISTS (SELECT 1 FROM cat_ts_quotas q WHERE q.max_bytes = -1 AND q.db_name = s.db_name AND q.username = s.owner
                  AND q.tablespace_name = s.tablespace_name)""")
def q_missing_quota(R):
    return sec.missing_quota(R.segments, R.sys_privs, R.ts_quotas)


@register("expiring_accounts", """
SELECT db_name, username, account_status, lock_date, expiry_date FROM cat_users
WHERE expiry_date IS NOT NULL AND username NOT LIKE '%SYS%' AND username NOT IN (SELECT owner FROM cat_internal_owners)""")
def q_expiring_accounts(R):
    return sec.expiring_accounts(R.users, R.internal_owners)


@register("role_inventory", """
SELECT db_name, 'Role,' || role AS line FROM cat_roles
UNION ALL
SELECT db_name, 'RoleGrant,' || granted_role || ',' || grantee FROM cat_role_privs
WHERE grantee NOT LIKE '%SYS%' AND grantee NOT LIKE 'APEX%' AND grantee NOT IN (SELECT owner FROM cat_internal_owners)
UNION ALL
SELECT db_name, 'RoleSysPrivs,' || grantee || ',' || privilege FROM cat_sys_privs p
WHERE EXISTS (SELECT 1 FROM cat_roles r WHERE r.db_name = p.db_name AND r.role = p.grantee)""")
def q_role_inventory(R):
    return sec.role_inventory(R.roles, R.role_privs, R.sys_privs, R.internal_owners)


@register("object_grants", """
SELECT DISTINCT db_name, privilege || ' on ' || owner || '."' || table_name || '" from ' || grantee || ';' AS line
FROM cat_tab_privs WHERE owner NOT LIKE 'APEX%' AND owner NOT IN (SELECT owner FROM cat_internal_owners)""")
def q_object_grants(R):
    return sec.object_grants(R.tab_privs, R.internal_owners)
