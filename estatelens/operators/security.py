"""Security and accounts.

``tab_privs`` is the large role here: every rule reduces it with filters
and distinct keys before it meets another table, and membership tests
are semi/anti joins keyed by ``db_name`` plus the object/grantee key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.functions.deal import dealt
from estatelens.functions.findings import finding, not_internal
from estatelens.functions.sqlcompat import before_last, nz_concat
from estatelens.functions.fleet import per_database

# Object privileges regarded as excessive between schemas.
RISKY_PRIVILEGES = ("ON COMMIT REFRESH", "FLASHBACK", "QUERY REWRITE", "INDEX", "DEBUG", "ALTER")
# Fixed value: account excluded from the default-password report.
DEFAULT_PWD_EXCLUDE = ("XS$NULL",)


def _dot(a, b):
    return nz_concat(F.col(a), ".", F.col(b))


def sequence_defaults(columns: DataFrame) -> DataFrame:
    """(db_name, owner, table_name, seq_schema, seq_name) for column
    defaults that call ``<seq>.nextval``. The whole default text is parsed.
    Unqualified sequences get schema 'unknown' (S4, computed per row)."""
    txt = F.trim(F.lower(F.col("data_default")))
    seq = before_last(txt, ".")                         # drop the trailing ".nextval"
    st = F.col("seq_txt")
    qualified = F.instr(st, ".") > 0
    schema = F.when(qualified, F.regexp_replace(F.upper(F.substring_index(st, ".", 1)), '"', "")) \
        .otherwise(F.lit("unknown"))
    name = F.when(qualified, F.regexp_replace(F.upper(F.expr("substring(seq_txt, instr(seq_txt, '.') + 1)")), '"', "")) \
        .otherwise(st)
    return (columns.filter(F.col("data_default").isNotNull() & txt.like("%nextval%"))
            .select("db_name", "owner", "table_name", seq.alias("seq_txt"))
            .select("db_name", "owner", "table_name", schema.alias("seq_schema"), name.alias("seq_name"))
            .distinct())


def missing_sequence_grants(columns: DataFrame, tab_privs: DataFrame) -> DataFrame:
    """Grantees that may INSERT into a table whose column default uses a
    sequence, but may not SELECT from that sequence."""
    seqs = sequence_defaults(columns)
    inserters = (tab_privs.filter(F.col("privilege") == "INSERT")
                 .select("db_name", "owner", "table_name", "grantee").distinct())
    # a sequence becomes a row per grantee: they are made in many tasks and dealt out before they are compared
    key = ["db_name", "seq_schema", "seq_name", "grantee"]
    need = dealt(dealt(seqs, *seqs.columns).join(inserters, ["db_name", "owner", "table_name"], "inner").select(*key), *key).distinct()
    have = (tab_privs.filter(F.col("privilege") == "SELECT")
            .select("db_name", F.col("owner").alias("seq_schema"), F.col("table_name").alias("seq_name"), "grantee")
            .distinct())
    miss = need.join(dealt(have, *key).hint("merge"), key, "left_anti")
    return finding(miss, "missing_sequence_grant", owner="seq_schema", object_name="seq_name",
                   detail=F.col("grantee"),
                   remedy=nz_concat("grant select on ", _dot("seq_schema", "seq_name"), " to ", F.col("grantee"), ";"))


def missing_grant_option(dependencies: DataFrame, tab_privs: DataFrame, objects: DataFrame,
                         internal_owners: DataFrame) -> DataFrame:
    """Views over another owner's table that are granted to someone, whose
    owner lacks SELECT WITH GRANT OPTION on that table."""
    granted_views = (tab_privs.filter(F.col("privilege") == "SELECT")
                     .select("db_name", "owner", "table_name").distinct()
                     .join(objects.filter(F.col("object_type") == "VIEW")
                           .select("db_name", "owner", F.col("object_name").alias("table_name")).distinct(),
                           ["db_name", "owner", "table_name"], "left_semi")
                     .withColumnRenamed("table_name", "name"))
    d = dependencies.filter((F.col("referenced_owner") != F.col("owner")) & (F.col("type") == "VIEW")
                            & (F.col("referenced_type") == "TABLE") & ~F.col("owner").like("APEX%"))
    d = not_internal(d, internal_owners).join(granted_views, ["db_name", "owner", "name"], "left_semi")
    need = d.select("db_name", "referenced_owner", "referenced_name", F.col("owner").alias("grantee")).distinct()
    have = (tab_privs.filter((F.col("privilege") == "SELECT") & (F.col("grantable") == "YES"))
            .select("db_name", F.col("owner").alias("referenced_owner"),
                    F.col("table_name").alias("referenced_name"), "grantee").distinct())
    miss = need.join(have, ["db_name", "referenced_owner", "referenced_name", "grantee"], "left_anti")
    return finding(miss, "missing_grant_option", owner="grantee", object_name="referenced_name",
                   remedy=nz_concat("grant select on ", _dot("referenced_owner", "referenced_name"), " to ",
                                    F.col("grantee"), " with grant option;"))


def excessive_grants(tab_privs: DataFrame, users: DataFrame, internal_owners: DataFrame,
                     privileges=RISKY_PRIVILEGES, ordered: bool = False) -> DataFrame:
    """Risky object privileges granted between non-internal user schemas."""
    io = internal_owners.select(F.col("owner").alias("grantee")).distinct()
    p = (tab_privs.filter((F.col("grantee") != F.col("owner")) & ~F.col("grantee").like("APEX%")
                          & F.col("privilege").isin(list(privileges)))
         .join(users.select("db_name", F.col("username").alias("owner")).distinct(), ["db_name", "owner"], "left_semi"))
    p = not_internal(p, internal_owners).join(F.broadcast(io), "grantee", "left_anti")
    if ordered:
        p = p.orderBy("grantee", "owner", "table_name", "privilege")
    return finding(p, "excessive_grant", owner="owner", object_name="table_name",
                   detail=nz_concat(F.col("privilege"), " to ", F.col("grantee")),
                   remedy=nz_concat("revoke ", F.col("privilege"), " on ", F.col("owner"), '."', F.col("table_name"),
                                    '" from ', F.col("grantee"), ";"))


def password_needs_change(users: DataFrame, user_history: DataFrame, profile: str, ordered: bool = False) -> DataFrame:
    """Users of ``profile`` with no password history or not OPEN, with
    their latest change date; ``ordered``: latest first, never-changed last (S2)."""
    u = users.filter(F.col("profile") == profile)
    j = u.join(user_history.select("db_name", "user_id", "password_date"), ["db_name", "user_id"], "left")
    out = (j.filter(F.col("password_date").isNull() | ~F.col("account_status").isin("OPEN"))
           .groupBy("db_name", "username", "profile", "account_status")
           .agg(F.max("password_date").alias("last_change")))
    return out.orderBy(F.col("last_change").desc_nulls_last(), "username") if ordered else out


def default_passwords(users_defpwd: DataFrame, exclude=DEFAULT_PWD_EXCLUDE) -> DataFrame:
    f = users_defpwd.filter(~F.col("username").isin(list(exclude)))
    return finding(f, "default_password", owner="username", object_name="username",
                   remedy=nz_concat("-- ", F.col("username"), " has default password!\nalter user ",
                                    F.col("username"), ' identified by "<new password>";'))


def wrong_temp_tablespace(users: DataFrame, db_properties: DataFrame) -> DataFrame:
    dflt = (db_properties.filter(F.col("property_name") == "DEFAULT_TEMP_TABLESPACE")
            .select("db_name", F.col("property_value").alias("default_temp")))
    f = users.join(per_database(dflt), "db_name", "inner").filter(F.col("temporary_tablespace") != F.col("default_temp"))
    return finding(f, "wrong_temp_tablespace", owner="username", object_name="username",
                   detail=F.col("temporary_tablespace"),
                   remedy=nz_concat("alter user ", F.col("username"), " temporary tablespace ", F.col("default_temp"), ";"))


def aged_passwords(user_base: DataFrame, as_of: str, days: int = 90, ordered: bool = False) -> DataFrame:
    """Open user accounts (type 1, not roles) whose password is older than ``days``, with their profile."""
    cutoff = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(days)} DAYS")
    out = (user_base.filter((F.col("astatus") == 0) & (F.col("type_id") == 1) & (F.col("ptime") < cutoff))
           .select("db_name", "name", F.col("ptime").alias("last_password_change"), F.col("resource").alias("profile")))
    return out.orderBy("db_name", "profile", "name") if ordered else out


def elevated_privileges(pwfile_users: DataFrame, role_privs: DataFrame, exclude_sys: bool = True) -> DataFrame:
    """Password-file users (listed as SYSDBA) and DBA role grantees."""
    a = pwfile_users
    if exclude_sys:
        a = a.filter(F.col("username") != "SYS")
    a = a.select("db_name", F.lit("SYSDBA").alias("privilege"), F.col("username").alias("grantee"))
    b = (role_privs.filter((F.col("granted_role") == "DBA") & ~F.col("grantee").like("SYS%"))
         .select("db_name", F.lit("DBA").alias("privilege"), "grantee"))
    return a.unionByName(b)


def missing_quota(segments: DataFrame, sys_privs: DataFrame, ts_quotas: DataFrame) -> DataFrame:
    """(owner, tablespace) pairs in use by owners without the unlimited
    privilege and without an unlimited quota."""
    unlimited = (sys_privs.filter(F.col("privilege") == "UNLIMITED TABLESPACE")
                 .select("db_name", F.col("grantee").alias("owner")).distinct())
    pairs = (segments.select("db_name", "owner", "tablespace_name").distinct()
             .join(unlimited, ["db_name", "owner"], "left_anti"))
    quota = (ts_quotas.filter(F.col("max_bytes") == -1)
             .select("db_name", F.col("username").alias("owner"), "tablespace_name").distinct())
    miss = pairs.join(quota, ["db_name", "owner", "tablespace_name"], "left_anti")
    return finding(miss, "missing_quota", owner="owner", object_name="tablespace_name",
                   remedy=nz_concat("alter user ", F.col("owner"), " quota unlimited on ", F.col("tablespace_name"), ";"))


def expiring_accounts(users: DataFrame, internal_owners: DataFrame, ordered: bool = False) -> DataFrame:
    f = users.filter(F.col("expiry_date").isNotNull() & ~F.col("username").like("%SYS%"))
    f = not_internal(f, internal_owners, owner_col="username")
    out = f.select("db_name", "username", "account_status", "lock_date", "expiry_date")
    return out.orderBy("db_name", "username") if ordered else out


def role_inventory(roles: DataFrame, role_privs: DataFrame, sys_privs: DataFrame,
                   internal_owners: DataFrame) -> DataFrame:
    """Roles; role grants to non-internal grantees; system privileges held by roles."""
    r = roles.select("db_name", nz_concat("Role,", F.col("role")).alias("line"))
    g = role_privs.filter(~F.col("grantee").like("%SYS%") & ~F.col("grantee").like("APEX%"))
    g = not_internal(g, internal_owners, owner_col="grantee").select(
        "db_name", nz_concat("RoleGrant,", F.col("granted_role"), ",", F.col("grantee")).alias("line"))
    s = (sys_privs.join(roles.select("db_name", F.col("role").alias("grantee")).distinct(), ["db_name", "grantee"], "left_semi")
         .select("db_name", nz_concat("RoleSysPrivs,", F.col("grantee"), ",", F.col("privilege")).alias("line")))
    return r.unionByName(g).unionByName(s)


def object_grants(tab_privs: DataFrame, internal_owners: DataFrame) -> DataFrame:
    """Distinct object grant lines of non-internal owners."""
    f = not_internal(tab_privs.filter(~F.col("owner").like("APEX%")), internal_owners)
    return f.select("db_name", nz_concat(F.col("privilege"), " on ", F.col("owner"), '."', F.col("table_name"),
                                         '" from ', F.col("grantee"), ";").alias("line")).distinct()
