"""Constraints, jobs and index usage plans.

The one procedural counter of the source (numbering a table's unique
keys) is a ``row_number`` window partitioned by (db_name, owner,
table_name) — bounded per table, so no single hot window partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from estatelens.functions.deal import dealt
from estatelens.functions.findings import not_internal
from estatelens.functions.sqlcompat import nz_concat

# Owners skipped by the key rename plans.
KEY_RENAME_EXCLUDE = ("DBSNMP", "XDB")
# Owners skipped by the unused-index report.
UNUSED_INDEX_EXCLUDE = ("ENT_COMMON", "GGS")
# Flag bits (index flags: monitoring on; usage flags: used).
MONITORING_BIT = 65536
USED_BIT = 1
INDEX_KEY = ["db_name", "owner", "index_name"]


def _q(c):
    return nz_concat("'", F.col(c), "'") if isinstance(c, str) else nz_concat("'", c, "'")


# ------------------------------------------------------------ constraints

def constraint_toggle_plan(constraints: DataFrame, owner: str | None = None, status: str | None = None) -> DataFrame:
    """Disable and enable remedies for a schema's constraints (disable
    quotes the table name, enable does not)."""
    c = constraints
    if owner is not None:
        c = c.filter(F.col("owner") == owner)
    if status is not None:
        c = c.filter(F.col("status") == status)
    dis = nz_concat("alter table ", F.col("owner"), '."', F.col("table_name"), '" disable constraint ',
                    F.col("constraint_name"), ";")
    ena = nz_concat("alter table ", F.col("owner"), ".", F.col("table_name"), " enable constraint ",
                    F.col("constraint_name"), ";")
    both = F.explode(F.array(F.struct(F.lit("disable").alias("action"), dis.alias("remedy")),
                             F.struct(F.lit("enable").alias("action"), ena.alias("remedy"))))
    return (c.select("db_name", "owner", "table_name", "constraint_name", both.alias("x"))
            .select("db_name", "owner", "table_name", "constraint_name", "x.action", "x.remedy"))


def _key_owners(c: DataFrame, exclude) -> DataFrame:
    return c.filter(~F.col("owner").like("%SYS%") & ~F.col("owner").isin(list(exclude)))


def unique_key_rename_plan(constraints: DataFrame, cons_columns: DataFrame, exclude_owners=KEY_RENAME_EXCLUDE) -> DataFrame:
    """On tables with more than one unique key, number the system-named
    unique keys by their first column (ties by name) as UK<n>_<table>,
    counting per owner and table (S20); rename constraint and index."""
    u = _key_owners(constraints, exclude_owners).filter(F.col("constraint_type") == "U")
    multi = (u.groupBy("db_name", "owner", "table_name").agg(F.count(F.lit(1)).alias("n"))
             .filter(F.col("n") > 1).drop("n"))
    sysu = (u.filter(F.col("constraint_name").like("SYS%"))
            .join(multi, ["db_name", "owner", "table_name"], "left_semi")
            .select("db_name", "owner", "table_name", "constraint_name", "index_name"))
    firstcol = (cons_columns.groupBy("db_name", "owner", "table_name", "constraint_name")
                .agg(F.min("column_name").alias("first_column")))
    k = sysu.join(firstcol, ["db_name", "owner", "table_name", "constraint_name"], "inner")
    w = Window.partitionBy("db_name", "owner", "table_name").orderBy(F.col("first_column").asc_nulls_last(), "constraint_name")
    k = k.withColumn("n", F.row_number().over(w)).withColumn(
        "new_name", nz_concat("UK", F.col("n").cast("string"), "_", F.col("table_name")))
    con = nz_concat("ALTER TABLE ", F.col("owner"), ".", F.col("table_name"), " RENAME CONSTRAINT ",
                    F.col("constraint_name"), " TO ", F.col("new_name"), ";")
    idx = nz_concat("ALTER INDEX ", F.col("owner"), ".", F.col("index_name"), " RENAME TO ", F.col("new_name"), ";")
    both = F.explode(F.array(F.struct(F.lit("constraint").alias("target"), con.alias("remedy")),
                             F.struct(F.lit("index").alias("target"), idx.alias("remedy"))))
    # one pass over the numbered keys emits both renames
    return (k.select("db_name", "owner", "table_name", "constraint_name", "new_name", both.alias("x"))
            .select("db_name", "owner", "table_name", "constraint_name", "new_name", "x.target", "x.remedy"))


def key_rename_plan(constraints: DataFrame, exclude_owners=KEY_RENAME_EXCLUDE, max_len: int = 27) -> DataFrame:
    """System-named primary and unique keys renamed PK_/UK_ + the first
    ``max_len`` characters of the table name (constraint and index)."""
    c = _key_owners(constraints, exclude_owners).filter(
        F.col("constraint_name").like("SYS%") & F.col("constraint_type").isin("P", "U"))
    new = nz_concat(F.when(F.col("constraint_type") == "P", "PK_").otherwise("UK_"),
                    F.substring("table_name", 1, max_len))
    return c.select(
        "db_name", "owner", "table_name",
        nz_concat("ALTER TABLE ", F.col("owner"), ".", F.col("table_name"), " RENAME CONSTRAINT ",
                  F.col("constraint_name"), " TO ", new).alias("constraint_ddl"),
        nz_concat("ALTER INDEX ", F.col("owner"), ".", F.col("index_name"), " RENAME TO ", new).alias("index_ddl"),
    ).distinct()


# ------------------------------------------------------------------- jobs

def job_toggle_plan(scheduler_jobs: DataFrame, jobs: DataFrame) -> DataFrame:
    """Disable / enable remedies for scheduler and legacy jobs that are
    enabled now, and stop remedies for enabled scheduler jobs running now."""
    name = nz_concat(F.col("owner"), ".", F.col("job_name"))
    jid = F.col("job").cast("string")

    def cmd(phase, text):
        return F.struct(F.lit(phase).alias("phase"), text.alias("command"))
    sched = F.array(cmd("disable", nz_concat("exec sys.dbms_scheduler.disable(", _q(name), ")")),
                    cmd("stop", F.when(F.col("state") == "RUNNING",
                                       nz_concat("exec sys.dbms_scheduler.stop_job(", _q(name), ", TRUE)"))),
                    cmd("enable", nz_concat("exec sys.dbms_scheduler.enable(", _q(name), ")")))
    legacy = F.array(cmd("disable", nz_concat("exec sys.dbms_ijob.broken(", jid, ", TRUE)")),
                     cmd("enable", nz_concat("exec sys.dbms_ijob.broken(", jid, ", FALSE)")))
    # each job row is read once and emits its commands
    a = (scheduler_jobs.filter(F.col("enabled") == "TRUE")
         .select("db_name", F.lit("scheduler").alias("kind"), name.alias("job"), F.explode(sched).alias("x")))
    b = (jobs.filter(F.col("broken") == "N")
         .select("db_name", F.lit("job").alias("kind"), jid.alias("job"), F.explode(legacy).alias("x")))
    return (a.unionByName(b).filter(F.col("x.command").isNotNull())
            .select("db_name", "x.phase", "kind", "job", "x.command"))


def job_counts(scheduler_jobs: DataFrame, jobs: DataFrame) -> DataFrame:
    a = (scheduler_jobs.groupBy("db_name")
         .agg(F.sum(F.when(F.col("enabled") == "TRUE", 1).otherwise(0)).cast("bigint").alias("scheduler_enabled")))
    b = (jobs.groupBy("db_name")
         .agg(F.sum(F.when(F.col("broken") == "N", 1).otherwise(0)).cast("bigint").alias("jobs_enabled")))
    return (a.join(b, "db_name", "full_outer")
            .select("db_name", F.coalesce("scheduler_enabled", F.lit(0)).alias("scheduler_enabled"),
                    F.coalesce("jobs_enabled", F.lit(0)).alias("jobs_enabled")))


# ------------------------------------------------------------ index usage

def decode_index_usage(ind_flags: DataFrame, object_usage: DataFrame, dict_objects: DataFrame) -> DataFrame:
    """Index usage view from dictionary rows: monitoring from the index
    flag bit, used from the usage flag bit."""
    io = dict_objects.select("db_name", "obj_id", "owner", F.col("name").alias("index_name"))
    t = dict_objects.select("db_name", F.col("obj_id").alias("bo_id"), F.col("name").alias("table_name"))
    j = (object_usage.select("db_name", "obj_id", F.col("flags").alias("u_flags"), "start_monitoring", "end_monitoring")
         .join(ind_flags.select("db_name", "obj_id", "bo_id", F.col("flags").alias("i_flags")), ["db_name", "obj_id"])
         .join(io, ["db_name", "obj_id"])
         .join(t, ["db_name", "bo_id"]))
    yn = lambda c, bit: F.when(F.col(c).bitwiseAND(F.lit(bit)) == 0, "NO").otherwise("YES")
    return j.select("db_name", "owner", "index_name", "table_name",
                    yn("i_flags", MONITORING_BIT).alias("monitoring"), yn("u_flags", USED_BIT).alias("used"),
                    "start_monitoring", "end_monitoring")


def _fk_index_rows(ind_columns: DataFrame, constraints: DataFrame, cons_columns: DataFrame) -> DataFrame:
    """fk_indexes, an index once for each of its key columns."""
    parent = ["db_name", "r_owner", "r_constraint_name"]
    c = constraints.filter(F.col("constraint_type") == "R").select(
        "db_name", "owner", "table_name", "constraint_name", "r_owner", "r_constraint_name")
    cc = cons_columns.select("db_name", "owner", "constraint_name", "column_name", "position")
    rc = cons_columns.select("db_name", F.col("owner").alias("r_owner"), F.col("constraint_name").alias("r_constraint_name"),
                             "position")
    r = constraints.select("db_name", F.col("owner").alias("r_owner"), F.col("constraint_name").alias("r_constraint_name"))
    # the columns are a set, so a parent need only exist
    own = ["db_name", "owner", "constraint_name"]
    cols = c.join(dealt(r, *parent).hint("merge"), parent, "left_semi").join(dealt(cc, *own).hint("merge"), own)
    fk_cols = (cols.join(dealt(rc, *parent, "position").hint("merge"), [*parent, "position"], "left_semi")
               .select("db_name", F.col("owner").alias("table_owner"), "table_name", "column_name",
                       F.col("position").alias("column_position")).distinct())
    return (ind_columns.join(fk_cols, ["db_name", "table_owner", "table_name", "column_name", "column_position"], "left_semi")
            .select("db_name", F.col("index_owner").alias("owner"), "index_name"))


def fk_indexes(ind_columns: DataFrame, constraints: DataFrame, cons_columns: DataFrame) -> DataFrame:
    """(db_name, owner, index_name) of indexes holding a foreign-key
    column at the key column's position."""
    return _fk_index_rows(ind_columns, constraints, cons_columns).distinct()


def _monitor_remedy(df: DataFrame, on: bool = True) -> DataFrame:
    word = " monitoring usage;" if on else " nomonitoring usage;"
    return df.select("db_name", "owner", "index_name",
                     nz_concat("alter index ", F.col("owner"), '."', F.col("index_name"), '"', word).alias("remedy"))


def unmonitored_indexes(indexes: DataFrame, index_usage: DataFrame, ind_columns: DataFrame, constraints: DataFrame,
                        cons_columns: DataFrame, internal_owners: DataFrame) -> DataFrame:
    """Non-unique normal/bitmap indexes never monitored, except indexes on
    foreign-key columns."""
    i = indexes.filter(F.col("index_type").isin("NORMAL", "BITMAP") & (F.col("uniqueness") == "NONUNIQUE"))
    known = dealt(index_usage.select(*INDEX_KEY).unionByName(_fk_index_rows(ind_columns, constraints, cons_columns)), *INDEX_KEY)
    i = not_internal(i, internal_owners).join(known.hint("merge"), INDEX_KEY, "left_anti")
    return _monitor_remedy(dealt(i, *INDEX_KEY)).distinct()


def restart_monitoring(index_usage: DataFrame, ind_columns: DataFrame, constraints: DataFrame,
                       cons_columns: DataFrame) -> DataFrame:
    u = index_usage.filter((F.col("monitoring") == "NO") & ~F.col("owner").like("APEX%"))
    known = dealt(_fk_index_rows(ind_columns, constraints, cons_columns), *INDEX_KEY)
    u = u.join(known.hint("merge"), INDEX_KEY, "left_anti")
    return _monitor_remedy(dealt(u, *INDEX_KEY)).distinct()


def stop_monitoring(index_usage: DataFrame) -> DataFrame:
    u = index_usage.filter((F.col("monitoring") == "YES") & (F.col("used") == "YES"))
    return _monitor_remedy(u, on=False)


def unused_indexes(index_usage: DataFrame, exclude_owners=UNUSED_INDEX_EXCLUDE, ordered: bool = False) -> DataFrame:
    """Monitored indexes not used since monitoring started; oldest first."""
    since = F.to_date(F.try_to_timestamp(F.col("start_monitoring"), F.lit("MM-dd-yyyy HH:mm:ss")))
    u = (index_usage.filter((F.col("used") == "NO") & (F.col("monitoring") == "YES")
                            & ~F.col("owner").isin(list(exclude_owners)))
         .withColumn("since", since))
    if ordered:                               # oldest first, as the source lists them
        u = u.orderBy(F.col("since").asc_nulls_last(), "owner", "table_name", "index_name")
    return (u
            .select("db_name", "owner", "index_name", "table_name", "since",
                    nz_concat(F.col("owner"), ".", F.col("index_name"), " on ", F.col("table_name"),
                              " not used since ", F.date_format("since", "MM/dd/yy")).alias("line")))


def invisible_indexes(indexes: DataFrame) -> DataFrame:
    return (indexes.filter(F.col("visibility") == "INVISIBLE")
            .select("db_name", "owner", "index_name", "table_name",
                    nz_concat(F.col("owner"), ".", F.col("index_name"), " on ", F.col("table_name")).alias("line")))
