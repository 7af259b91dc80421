"""Partition lifecycle and layout drift.

Plans are DataFrames of remedy rows; nothing is executed. Policy inputs
(owner groups, retention policies, rename rules) are small parameter
tables, broadcast because their size is fixed by the caller. The table
rewrite (`range_partition_copy`) writes a month-partitioned Parquet table
so later reads prune by month.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelens.functions.deal import dealt
from estatelens.functions.findings import not_internal
from estatelens.functions.sqlcompat import nz_concat
from estatelens.session import checkpoint_dir

# Owners never offered for row movement or shrink.
ROW_MOVEMENT_EXCLUDE = ("OUTLN", "XDB", "GSMADMIN_INTERNAL", "GGS")
SHRINK_EXCLUDE = ("OUTLN", "XDB", "GSMADMIN_INTERNAL", "GGS", "VIZ")
# Fixed value: default tablespace that counts as current for any month.
SHORT_TERM = "SHORT_TERM"


# ------------------------------------------------------- table rewrite

def month_of(c: Column) -> Column:
    """First day of the month as DATE (zone-less, S28)."""
    return F.trunc(F.to_date(c), "month")


_UNITS = {"day": None, "month": "month", "year": "year"}


def range_partition_copy(df: DataFrame, date_col: str, path: str | None = None,
                         part_col: str = "part_month", unit: str = "month") -> DataFrame:
    """Rewrite ``df`` into ``unit`` (day, month or year) range partitions on ``date_col`` under
    ``path`` (default: a fresh folder below the session checkpoint dir)
    and return the copy as read back. New months appear as new folders.
    Rows are clustered by month before writing so each task writes few
    files per month."""
    spark = df.sparkSession
    if path is None:
        path = f"{checkpoint_dir(spark).rstrip('/')}/estatelens/range_copy/{uuid.uuid4().hex}"
    if unit not in _UNITS:
        raise ValueError(f"unit must be one of {sorted(_UNITS)}")
    day = F.to_date(F.col(date_col))
    out = df.withColumn(part_col, day if _UNITS[unit] is None else F.trunc(day, _UNITS[unit]))
    # rebalance (not repartition): AQE splits a hot month over several
    # tasks and merges small ones, so no single task writes a skewed month
    (out.hint("rebalance", part_col)
        .write.mode("overwrite").partitionBy(part_col).parquet(path))
    return spark.read.schema(out.schema).parquet(path)


def sync_delta(interim: DataFrame, source: DataFrame, keys) -> DataFrame:
    """Changes that bring ``interim`` up to date with ``source`` by key:
    op = insert (key only in source), update (row differs), delete (key
    only in interim). Columns: op, keys, then the source's other columns."""
    keys = list(keys)
    cols = [c for c in source.columns if c not in keys]
    s = source.select(*keys, *[F.col(c).alias(f"__s_{c}") for c in cols], F.lit(True).alias("__in_s"))
    i = interim.select(*keys, *[F.col(c).alias(f"__i_{c}") for c in cols], F.lit(True).alias("__in_i"))
    j = s.join(i, keys, "full_outer")
    same = reduce(lambda a, b: a & b, [F.col(f"__s_{c}").eqNullSafe(F.col(f"__i_{c}")) for c in cols], F.lit(True))
    op = (F.when(F.col("__in_i").isNull(), "insert")
          .when(F.col("__in_s").isNull(), "delete")
          .when(~same, "update"))
    return (j.withColumn("op", op).filter(F.col("op").isNotNull())
            .select("op", *keys, *[F.col(f"__s_{c}").alias(c) for c in cols]))


def apply_delta(interim: DataFrame, delta: DataFrame, keys) -> DataFrame:
    """``interim`` with ``sync_delta`` applied (anti-join + union)."""
    keys = list(keys)
    kept = interim.join(delta.select(*keys), keys, "left_anti")
    upserts = delta.filter(F.col("op") != "delete").drop("op")
    return kept.unionByName(upserts.select(*interim.columns))


def reconcile_counts(source: DataFrame, copy: DataFrame, by: Column | None = None,
                     check_cols=()) -> DataFrame:
    """Row counts (and sums of ``check_cols``) of original vs copy per
    group; ``matches`` is true when all agree."""
    def agg(df, tag):
        g = df.groupBy(by.alias("grp")) if by is not None else df.groupBy(F.lit("all").alias("grp"))
        return g.agg(F.count(F.lit(1)).alias(f"{tag}_rows"),
                     *[F.sum(c).alias(f"{tag}_sum_{c}") for c in check_cols])
    j = agg(source, "source").join(agg(copy, "copy"), "grp", "full_outer")
    eq = F.coalesce(F.col("source_rows"), F.lit(0)) == F.coalesce(F.col("copy_rows"), F.lit(0))
    for c in check_cols:
        eq = eq & F.col(f"source_sum_{c}").eqNullSafe(F.col(f"copy_sum_{c}"))
    return j.withColumn("matches", eq)


# ------------------------------------------------------- rename plans

@dataclass(frozen=True)
class RenameRule:
    """How system-named partitions of selected tables get their name.

    kind: 'day' (date high value, YYYY_MMDD of the day before),
    'num3' (first three digits - 1), 'interval_num' (whole number - 1),
    'int_month' (YYYYMM[DD] integer, month 13 means year end),
    'date_month' (date high value, YYYY_MM of the day before).
    ``tables``/``owners`` select by name (None = any); ``exclude_tables``
    removes names; ``interval`` selects tables by their interval text;
    ``strip`` is removed from the table name before the 18-char stub.
    """
    kind: str
    tables: tuple | None = None
    owners: tuple | None = None
    exclude_tables: tuple = ()
    interval: str | None = None
    strip: str = ""
    skip_internal: bool = False
    skip_owner_like: tuple = field(default_factory=tuple)


# The source's five rename blocks, in execution order.
DEFAULT_RENAME_RULES = (
    RenameRule("day", tables=("LOG", "QUEUE"), owners=("SCOTT",)),
    RenameRule("num3", tables=("DETAIL",), owners=("SCOTT",)),
    RenameRule("interval_num", interval="10000"),
    RenameRule("int_month", tables=("HISTORY",), owners=("SCOTT",)),
    RenameRule("date_month", exclude_tables=("TRANSACTIONS", "HISTORY"), strip="TAR_",
               skip_internal=True, skip_owner_like=("APEX%",)),
)


def _trim_underscore(c: Column) -> Column:
    return F.regexp_replace(c, r"^_+|_+$", "")


def _new_name(rule: RenameRule, hv: Column, table: Column) -> Column:
    t = F.replace(table, F.lit(rule.strip), F.lit("")) if rule.strip else table
    stub = _trim_underscore(F.substring(t, 1, 18))
    if rule.kind in ("day", "date_month"):
        d = F.date_sub(F.try_to_date(F.substring(hv, 11, 10), "yyyy-MM-dd"), 1)
        suffix = F.date_format(d, "yyyy_MMdd" if rule.kind == "day" else "yyyy_MM")
    elif rule.kind == "num3":
        suffix = (F.trim(F.substring(hv, 1, 3)).try_cast("int") - 1).cast("string")
    elif rule.kind == "interval_num":
        suffix = (F.trim(hv).try_cast("bigint") - 1).cast("string")
    elif rule.kind == "int_month":
        mon = F.substring(hv, 5, 2).try_cast("int")
        year_end = F.try_to_date(F.concat(F.substring(hv, 1, 4), F.lit("12")), "yyyyMM")
        day_before = F.date_sub(F.try_to_date(F.substring(hv, 1, 8), "yyyyMMdd"), 1)
        suffix = F.date_format(F.when(mon.isNull(), None).when(mon > 12, year_end).otherwise(day_before), "yyyy_MM")
    else:
        raise ValueError(rule.kind)
    return F.when(suffix.isNotNull(), F.concat(stub, F.lit("_"), suffix))


def _selects(rule: RenameRule) -> Column:
    c = F.lit(True)
    if rule.tables is not None:
        c = c & F.col("table_name").isin(list(rule.tables))
    if rule.owners is not None:
        c = c & F.col("table_owner").isin(list(rule.owners))
    if rule.exclude_tables:
        c = c & ~F.col("table_name").isin(list(rule.exclude_tables))
    for pat in rule.skip_owner_like:
        c = c & ~F.col("table_owner").like(pat)
    if rule.skip_internal:
        c = c & ~F.col("__internal")
    if rule.interval is not None:
        c = c & (F.col("__interval") == rule.interval)
    return c


def partition_rename_plan(tab_partitions: DataFrame, part_tables: DataFrame, internal_owners: DataFrame,
                          rules=DEFAULT_RENAME_RULES) -> DataFrame:
    """System-named partitions renamed to stub + suffix derived from the
    high value minus one unit. Rules apply in order and the first rule
    that selects the table and parses the high value wins (a bad value
    yields no plan, S11). Only rows whose name changes are kept."""
    io = F.broadcast(internal_owners.select(F.col("owner").alias("table_owner"), F.lit(True).alias("__known")).distinct())   # built-in schema list
    pt = part_tables.select("db_name", F.col("owner").alias("table_owner"), "table_name",
                            F.col("interval").alias("__interval")).distinct()
    sysp = tab_partitions.filter(F.col("partition_name").like("SYS%"))
    flagged = sysp.join(io, "table_owner", "left").withColumn("__internal", F.col("__known").isNotNull())
    p = flagged.join(pt, ["db_name", "table_owner", "table_name"], "left")
    hv, tn = F.col("high_value"), F.col("table_name")
    tried = F.array(*[F.struct(F.lit(r.kind).alias("rule"), F.when(_selects(r), _new_name(r, hv, tn)).alias("new_name")) for r in rules])
    first = F.get(F.filter(tried, lambda t: t["new_name"].isNotNull()), 0)
    return (p.withColumn("won", first).select("*", "won.rule", "won.new_name")
            .filter(F.col("new_name").isNotNull() & (F.col("partition_name") != F.col("new_name")))
            .select("db_name", "table_owner", "table_name", "partition_name", "new_name", "rule",
                    nz_concat("alter table ", F.col("table_owner"), ".", F.col("table_name"), " rename partition ",
                              F.col("partition_name"), " to ", F.col("new_name"), ";").alias("remedy")))


def apply_rename(tab_partitions: DataFrame, plan: DataFrame) -> DataFrame:
    """Partitions as named after a rename plan."""
    p = plan.select("db_name", "table_owner", "table_name", "partition_name", "new_name")
    return (tab_partitions.join(p, ["db_name", "table_owner", "table_name", "partition_name"], "left")
            .withColumn("partition_name", F.coalesce("new_name", "partition_name")).drop("new_name"))


def index_partition_rename(ind_partitions: DataFrame, part_indexes: DataFrame, tab_partitions: DataFrame,
                           internal_owners: DataFrame, ordered: bool = False) -> DataFrame:
    """Local index partitions named unlike the table partition at the same position."""
    pi = part_indexes.select("db_name", F.col("owner").alias("index_owner"), "index_name",
                             F.col("owner").alias("table_owner"), "table_name")
    tp = tab_partitions.select("db_name", "table_owner", "table_name", "partition_position",
                               F.col("partition_name").alias("table_partition"))
    j = (ind_partitions.join(pi, ["db_name", "index_owner", "index_name"], "inner")
         .join(tp, ["db_name", "table_owner", "table_name", "partition_position"], "inner")
         .filter((F.col("partition_name") != F.col("table_partition")) & ~F.col("partition_name").like("SYS_IL%")))
    j = not_internal(j, internal_owners, owner_col="table_owner")
    out = j.select("db_name", "table_owner", "table_name", "partition_position", "index_owner", "index_name",
                   "partition_name", F.col("table_partition").alias("new_name"),
                   nz_concat("ALTER INDEX ", F.col("index_owner"), ".", F.col("index_name"), " RENAME PARTITION ",
                             F.col("partition_name"), " TO ", F.col("table_partition"), ";").alias("remedy"))
    return out.orderBy("db_name", "table_owner", "table_name", "partition_position", "index_name") if ordered else out


def index_partition_colocate(tab_partitions: DataFrame, ind_partitions: DataFrame, part_indexes: DataFrame, owners) -> DataFrame:
    """Index partitions stored in another tablespace than the partition of
    the same name of their own table. ``part_indexes`` names the table of an
    index: owner and partition name alone would also pair an index with other
    tables of the owner that use the same partition names."""
    t = (tab_partitions.filter(F.col("table_owner").isin(list(owners)))
         .select("db_name", F.col("table_owner").alias("index_owner"), "table_name", "partition_name",
                 F.col("tablespace_name").alias("table_tablespace")))
    own = part_indexes.select("db_name", F.col("owner").alias("index_owner"), "index_name", "table_name").distinct()
    j = (ind_partitions.join(own, ["db_name", "index_owner", "index_name"], "inner")
         .join(t, ["db_name", "index_owner", "table_name", "partition_name"], "inner")
         .filter(F.col("table_tablespace") != F.col("tablespace_name")))
    return j.select("db_name", "index_owner", "index_name", "partition_name",
                    nz_concat("alter index ", F.col("index_owner"), ".", F.col("index_name"), " rebuild partition ",
                              F.col("partition_name"), " tablespace ", F.col("table_tablespace"), " online;")
                    .alias("remedy"))


# --------------------------------------------------------- retention

POLICY_SCHEMA = "table_owner string, table_name string, prefix string, days int, fmt string"
# The source's retention policy (owner, table, name prefix, days, date pattern).
DEFAULT_RETENTION = [
    ("SCOTT", "LOG", "LOG_", 31, "yyyy_MMdd"),
    ("SCOTT", "EMAIL_QUEUE", "EMAIL_QUEUE_", 62, "yyyy_MMdd"),
    ("SCOTT", "REQUEST_LOG", "REQUEST_LOG_", 120, "yyyy_MMdd"),
    ("SCOTT", "HISTORY", "HISTORY_", 365, "yyyy_MM"),
]
# Date patterns a retention policy may use in partition names.
NAME_DATE_FORMATS = ("yyyy_MMdd", "yyyy_MM", "yyyyMMdd", "yyyyMM", "yyyy")


def expired_partitions(tab_partitions: DataFrame, policy: DataFrame | None, as_of: str) -> DataFrame:
    """Partitions whose name sorts before ``prefix || format(as_of - days)``
    (a name compare, S13); names must start with the prefix. ``policy``
    rows: (table_owner, table_name, prefix, days, fmt) with one of
    NAME_DATE_FORMATS; another format is an error, not an empty plan.
    None stands for DEFAULT_RETENTION."""
    if policy is None:
        policy = tab_partitions.sparkSession.createDataFrame(DEFAULT_RETENTION, POLICY_SCHEMA)
    cutoff_day = F.date_sub(F.to_date(F.lit(as_of).cast("timestamp_ntz")), F.col("days"))
    formatted = None
    for fmt in NAME_DATE_FORMATS:    # date_format needs a literal pattern
        f = F.when(F.col("fmt") == fmt, F.date_format(cutoff_day, fmt))
        formatted = f if formatted is None else formatted.when(F.col("fmt") == fmt, F.date_format(cutoff_day, fmt))
    unknown = F.raise_error(F.concat(F.lit("retention policy: unknown date format "), F.coalesce("fmt", F.lit("NULL"))))
    pol = policy.withColumn("cutoff_name", F.concat(F.col("prefix"), formatted.otherwise(unknown)))
    j = (tab_partitions.join(F.broadcast(pol), ["table_owner", "table_name"], "inner")
         .filter(F.col("partition_name").startswith(F.col("prefix"))
                 & (F.col("partition_name") < F.col("cutoff_name"))))
    return j.select("db_name", "table_owner", "table_name", "partition_name", "cutoff_name",
                    nz_concat("alter table ", F.col("table_owner"), ".", F.col("table_name"), " drop partition ",
                              F.col("partition_name"), " update global indexes;").alias("remedy"))


# ------------------------------------------------------- tablespaces

def missing_tablespaces(databases: DataFrame, tablespaces: DataFrame, prefixes, suffix: str) -> DataFrame:
    """Required ``<prefix>_<suffix>`` tablespaces that do not exist yet."""
    req = databases.select("db_name", F.explode(F.array(*[F.lit(f"{p}_{suffix}") for p in prefixes]))
                           .alias("tablespace_name")).distinct()
    miss = req.join(tablespaces.select("db_name", "tablespace_name"), ["db_name", "tablespace_name"], "left_anti")
    return miss.select("db_name", "tablespace_name",
                       nz_concat("create bigfile tablespace ", F.col("tablespace_name"), ";").alias("remedy"))


def _groups(spark, owner_groups: dict) -> DataFrame:
    return spark.createDataFrame(sorted(owner_groups.items()), "owner string, ts_prefix string")


def default_tablespace_drift(tables: DataFrame, part_tables: DataFrame, owner_groups: dict, suffix: str) -> DataFrame:
    """Partitioned tables of each owner group whose default tablespace is
    neither this period's ``<prefix>_<suffix>`` nor SHORT_TERM."""
    spark = tables.sparkSession
    g = F.broadcast(_groups(spark, owner_groups))      # caller-sized parameter table
    t = (tables.filter(F.col("partitioned") == "YES").select("db_name", "owner", "table_name")
         .join(g, "owner", "inner")
         .withColumn("target", F.concat(F.col("ts_prefix"), F.lit("_" + suffix))))
    ok = part_tables.select("db_name", "owner", "table_name", "def_tablespace_name")
    t = t.join(ok, ["db_name", "owner", "table_name"], "left")
    t = t.filter(~(F.coalesce(F.col("def_tablespace_name").isin(F.col("target"), F.lit(SHORT_TERM)), F.lit(False))))
    return t.select("db_name", "owner", "table_name", "target",
                    nz_concat("alter table ", F.col("owner"), ".", F.col("table_name"),
                              " MODIFY DEFAULT ATTRIBUTES TABLESPACE ", F.col("target"), ";").alias("remedy")).distinct()


def store_in_drift(tables: DataFrame, store_lists: DataFrame, owner_groups: dict, suffix: str) -> DataFrame:
    """Partitioned tables whose interval store list holds neither this
    period's tablespace nor SHORT_TERM."""
    spark = tables.sparkSession
    g = F.broadcast(_groups(spark, owner_groups))
    t = (tables.filter(F.col("partitioned") == "YES").select("db_name", "owner", "table_name")
         .join(g, "owner", "inner")
         .withColumn("target", F.concat(F.col("ts_prefix"), F.lit("_" + suffix))))
    has = (store_lists.select("db_name", "owner", "table_name", "tablespace_name")
           .join(t.select("db_name", "owner", "table_name", "target"), ["db_name", "owner", "table_name"], "inner")
           .filter(F.col("tablespace_name").isin(F.col("target"), F.lit(SHORT_TERM)))
           .select("db_name", "owner", "table_name").distinct())
    t = t.join(has, ["db_name", "owner", "table_name"], "left_anti")
    return t.select("db_name", "owner", "table_name", "target",
                    nz_concat("alter table ", F.col("owner"), ".", F.col("table_name"), " set store in (",
                              F.col("target"), ");").alias("remedy")).distinct()


def index_default_drift(part_indexes: DataFrame, part_tables: DataFrame, ordered: bool = False) -> DataFrame:
    t = part_tables.select("db_name", "owner", "table_name", F.col("def_tablespace_name").alias("table_ts"))
    j = (part_indexes.join(t, ["db_name", "owner", "table_name"], "inner")
         .filter(~F.col("owner").like("SYS%") & ~F.col("index_name").like("SYS%")
                 & (F.col("def_tablespace_name") != F.col("table_ts"))))
    out = j.select("db_name", "owner", "index_name", "table_name",
                   nz_concat("alter index ", F.col("owner"), ".", F.col("index_name"),
                             " MODIFY DEFAULT ATTRIBUTES TABLESPACE ", F.col("table_ts"), ";").alias("remedy"))
    return out.orderBy("remedy") if ordered else out


# ------------------------------------------------- row movement, shrink

def _mview_free(df: DataFrame, mviews: DataFrame, mview_logs: DataFrame, owner_col: str) -> DataFrame:
    key = ["db_name", owner_col, "table_name"]
    names = [m.select("db_name", F.col("owner").alias(owner_col), F.col("name").alias("table_name")) for m in (mviews, mview_logs)]
    return df.join(dealt(names[0].unionByName(names[1]), *key).hint("merge"), key, "left_anti")


def _fbi_free(df: DataFrame, indexes: DataFrame, owner_col: str) -> DataFrame:
    fbi = (indexes.filter(F.col("index_type").like("FUN%"))
           .select("db_name", F.col("table_owner").alias(owner_col), "table_name").distinct())
    return df.join(fbi, ["db_name", owner_col, "table_name"], "left_anti")


def _opt(df, max_rows, predicate):
    if max_rows is not None:
        df = df.filter(F.col("num_rows") < max_rows)
    if predicate:
        df = df.filter(F.expr(predicate))
    return df


def row_movement_candidates(tables: DataFrame, mviews: DataFrame, mview_logs: DataFrame,
                            exclude_owners=ROW_MOVEMENT_EXCLUDE, max_rows=None, predicate=None) -> DataFrame:
    t = tables.filter((F.col("row_movement") == "DISABLED") & F.col("iot_type").isNull()
                      & (F.col("temporary") == "N") & ~F.col("owner").like("%SYS%")
                      & ~F.col("owner").isin(list(exclude_owners)) & (F.col("compression") == "DISABLED"))
    t = _mview_free(_opt(t, max_rows, predicate), mviews, mview_logs, "owner")
    return t.select("db_name", "owner", "table_name",
                    nz_concat("alter table ", F.col("owner"), '."', F.col("table_name"), '" enable row movement;')
                    .alias("remedy"))


def shrink_candidates(tables: DataFrame, mviews: DataFrame, mview_logs: DataFrame, indexes: DataFrame,
                      exclude_owners=SHRINK_EXCLUDE, max_rows=None, predicate=None,
                      compact: bool = False, cascade: bool = True, ordered: bool = False) -> DataFrame:
    t = tables.filter((F.col("row_movement") == "ENABLED") & (F.col("segment_created") == "YES")
                      & F.col("iot_type").isNull() & (F.col("temporary") == "N") & (F.col("partitioned") == "NO")
                      & (F.col("compression") == "DISABLED") & (F.col("read_only") == "NO")
                      & ~F.col("owner").like("%SYS%") & ~F.col("owner").isin(list(exclude_owners)))
    t = _fbi_free(_mview_free(_opt(t, max_rows, predicate), mviews, mview_logs, "owner"), indexes, "owner")
    opts = (" COMPACT" if compact else "") + (" CASCADE" if cascade else "")
    if ordered:                       # smallest tables first, as the plan runs
        t = t.orderBy(F.col("num_rows").asc_nulls_last())
    return (t
            .select("db_name", "owner", "table_name", "num_rows",
                    nz_concat("alter table ", F.col("owner"), '."', F.col("table_name"), '" shrink space', opts, ";")
                    .alias("remedy")))


def shrink_partition_candidates(tab_partitions: DataFrame, tables: DataFrame, mviews: DataFrame,
                                mview_logs: DataFrame, indexes: DataFrame, exclude_owners=SHRINK_EXCLUDE,
                                predicate=None, ordered: bool = False) -> DataFrame:
    parents = tables.filter(F.col("iot_type").isNull() & (F.col("temporary") == "N")
                            & ~F.col("owner").like("%SYS%") & ~F.col("owner").isin(list(exclude_owners)))
    parents = _mview_free(_opt(parents, None, predicate), mviews, mview_logs, "owner") \
        .select("db_name", F.col("owner").alias("table_owner"), "table_name").distinct()
    p = (tab_partitions.filter((F.col("segment_created") == "YES") & (F.col("compression") == "DISABLED")
                               & ~F.col("partition_name").like("%0000"))
         .join(parents, ["db_name", "table_owner", "table_name"], "left_semi"))
    p = _fbi_free(_mview_free(p, mviews, mview_logs, "table_owner"), indexes, "table_owner")
    if ordered:
        p = p.orderBy(F.col("num_rows").asc_nulls_last())
    return (p
            .select("db_name", "table_owner", "table_name", "partition_name", "num_rows",
                    nz_concat("alter table ", F.col("table_owner"), ".", F.col("table_name"), " modify partition ",
                              F.col("partition_name"), " shrink space;").alias("remedy")))


def exclude_patterns(plan: DataFrame, patterns, col: str = "remedy") -> DataFrame:
    """Drop plan rows whose ``col`` contains any listed fixed text; blank
    patterns are ignored. One JVM-side predicate, no join."""
    pats = [p for p in patterns if p and p.strip()]
    if not pats:
        return plan
    hit = reduce(lambda a, b: a | b, [F.col(col).contains(p) for p in pats])
    return plan.filter(~F.coalesce(hit, F.lit(False)))
