"""Registered partition-lifecycle queries with oracle SQL.

Scenario for the table copy: the driver's ``orders`` is the user table
(key o_orderkey, date column o_orderdate). Every row is in the source and
in the interim copy, but some keys were moved since (negative), each on one
side only: the copy misses rows, holds rows deleted from the source, and has
one column changed on others.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from estatelens.operators import partitions as pa
from estatelens.plans.registry import register
from estatelens.sources.roles import ORDERS_AS_OF

SUFFIX = "200108"                       # period of ORDERS_AS_OF
TS_PREFIXES = ("ETL", "APP")
OWNER_GROUPS = {"APP": "APP", "U0": "ETL", "U5": "APP", "U10": "ETL", "U15": "APP", "U20": "ETL"}
EXCLUDE = ['U7."', '"T_1', "  "]
RETENTION = [("APP", f"TAR_SALES_{k}", f"SALES_{k}_", 365, "yyyy_MM") for k in range(3)] + pa.DEFAULT_RETENTION

_ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


def orders_source(orders):
    moved = F.col("o_orderkey") % 13 == 5
    return orders.withColumn("o_orderkey", F.when(moved, -F.col("o_orderkey")).otherwise(F.col("o_orderkey")))


def orders_interim(orders):
    key = F.col("o_orderkey")
    status = F.when(key % 7 == 0, F.lit("X")).otherwise(F.col("o_orderstatus"))
    return orders.withColumns({"o_orderkey": F.when(key % 10 == 3, -key).otherwise(key), "o_orderstatus": status})


_SRC = "(SELECT * REPLACE (CASE WHEN o_orderkey % 13 = 5 THEN -o_orderkey ELSE o_orderkey END AS o_orderkey) FROM orders)"
_INTERIM = ("(SELECT CASE WHEN o_orderkey % 10 = 3 THEN -o_orderkey ELSE o_orderkey END AS o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, "
            "o_totalprice, o_orderdate, o_orderpriority FROM orders)")
_DELTA = f"""SELECT CASE WHEN i.o_orderkey IS NULL THEN 'insert' WHEN s.o_orderkey IS NULL THEN 'delete' ELSE 'update' END AS op,
  coalesce(s.o_orderkey, i.o_orderkey) AS o_orderkey, s.o_custkey, s.o_orderstatus, s.o_totalprice, s.o_orderdate, s.o_orderpriority
FROM {_SRC} s FULL OUTER JOIN {_INTERIM} i ON s.o_orderkey = i.o_orderkey
WHERE i.o_orderkey IS NULL OR s.o_orderkey IS NULL
  OR s.o_custkey IS DISTINCT FROM i.o_custkey OR s.o_orderstatus IS DISTINCT FROM i.o_orderstatus
  OR s.o_totalprice IS DISTINCT FROM i.o_totalprice OR s.o_orderdate IS DISTINCT FROM i.o_orderdate
  OR s.o_orderpriority IS DISTINCT FROM i.o_orderpriority"""


@register("range_partition_copy", """
SELECT *, CAST(date_trunc('month', o_orderdate) AS DATE) AS part_month FROM orders""")
def q_range_partition_copy(R):
    return pa.range_partition_copy(R.driver("orders"), "o_orderdate")


@register("sync_delta", _DELTA)
def q_sync_delta(R):
    o = R.driver("orders")
    return pa.sync_delta(orders_interim(o), orders_source(o), ["o_orderkey"])


@register("reconcile_counts", f"""
WITH delta AS ({_DELTA}),
copy AS (
  SELECT * FROM {_INTERIM} i WHERE i.o_orderkey NOT IN (SELECT o_orderkey FROM delta)
  UNION ALL SELECT {_ORDER_COLS} FROM delta WHERE op <> 'delete'),
a AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS grp, count(*) AS source_rows,
        CAST(sum(o_orderkey) AS BIGINT) AS source_sum_o_orderkey FROM {_SRC} s GROUP BY 1),
b AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS grp, count(*) AS copy_rows,
        CAST(sum(o_orderkey) AS BIGINT) AS copy_sum_o_orderkey FROM copy GROUP BY 1)
SELECT grp, source_rows, source_sum_o_orderkey, copy_rows, copy_sum_o_orderkey,
  (coalesce(source_rows, 0) = coalesce(copy_rows, 0) AND source_sum_o_orderkey IS NOT DISTINCT FROM copy_sum_o_orderkey) AS matches
FROM a FULL OUTER JOIN b USING (grp)""")
def q_reconcile_counts(R):
    o = R.driver("orders")
    src, interim = orders_source(o), orders_interim(o)
    copy = pa.apply_delta(interim, pa.sync_delta(interim, src, ["o_orderkey"]), ["o_orderkey"])
    return pa.reconcile_counts(src, copy, by=pa.month_of(F.col("o_orderdate")), check_cols=["o_orderkey"])


def _stub(strip: str) -> str:
    t = f"replace(table_name, '{strip}', '')" if strip else "table_name"
    return f"regexp_replace(substr({t}, 1, 18), '^_+|_+$', '', 'g')"


_DAY = "CAST(try_strptime(substr(high_value, 11, 10), '%Y-%m-%d') AS DATE) - 1"
_N1 = f"{_stub('')} || '_' || strftime({_DAY}, '%Y_%m%d')"
_N2 = f"{_stub('')} || '_' || CAST(TRY_CAST(trim(substr(high_value, 1, 3)) AS INTEGER) - 1 AS VARCHAR)"
_N3 = f"{_stub('')} || '_' || CAST(TRY_CAST(trim(high_value) AS BIGINT) - 1 AS VARCHAR)"
_MON = "TRY_CAST(substr(high_value, 5, 2) AS INTEGER)"
_N4 = (f"{_stub('')} || '_' || strftime(CASE WHEN {_MON} IS NULL THEN NULL WHEN {_MON} > 12 "
       f"THEN CAST(try_strptime(substr(high_value, 1, 4) || '12', '%Y%m') AS DATE) "
       f"ELSE CAST(try_strptime(substr(high_value, 1, 8), '%Y%m%d') AS DATE) - 1 END, '%Y_%m')")
_N5 = f"{_stub('TAR_')} || '_' || strftime({_DAY}, '%Y_%m')"
_S1 = "table_name IN ('LOG', 'QUEUE') AND table_owner IN ('SCOTT')"
_S2 = "table_name IN ('DETAIL') AND table_owner IN ('SCOTT')"
_S3 = "coalesce(interval_txt = '10000', false)"
_S4 = "table_name IN ('HISTORY') AND table_owner IN ('SCOTT')"
_S5 = "table_name NOT IN ('TRANSACTIONS', 'HISTORY') AND table_owner NOT LIKE 'APEX%' AND NOT is_internal"
_CANDS = [(_S1, _N1, "day"), (_S2, _N2, "num3"), (_S3, _N3, "interval_num"), (_S4, _N4, "int_month"),
          (_S5, _N5, "date_month")]
_NEW = "CASE " + " ".join(f"WHEN ({s}) AND ({n}) IS NOT NULL THEN ({n})" for s, n, _ in _CANDS) + " END"
_RULE = "CASE " + " ".join(f"WHEN ({s}) AND ({n}) IS NOT NULL THEN '{k}'" for s, n, k in _CANDS) + " END"
_PLAN = f"""SELECT db_name, table_owner, table_name, partition_name, new_name, rule,
  'alter table ' || table_owner || '.' || table_name || ' rename partition ' || partition_name || ' to ' || new_name || ';' AS remedy
FROM (
  SELECT p.*, {_NEW} AS new_name, {_RULE} AS rule FROM (
    SELECT tp.*, tp.table_owner IN (SELECT owner FROM cat_internal_owners) AS is_internal,
      (SELECT max(pt.interval) FROM cat_part_tables pt WHERE pt.db_name = tp.db_name AND pt.owner = tp.table_owner
         AND pt.table_name = tp.table_name) AS interval_txt
    FROM cat_tab_partitions tp WHERE tp.partition_name LIKE 'SYS%') p) x
WHERE new_name IS NOT NULL AND partition_name <> new_name"""


@register("partition_rename_plan", _PLAN)
def q_partition_rename_plan(R):
    return pa.partition_rename_plan(R.tab_partitions, R.part_tables, R.internal_owners)


@register("index_partition_rename", """
SELECT p.db_name, p.table_owner, p.table_name, p.partition_position, ip.index_owner, ip.index_name, ip.partition_name,
  p.partition_name AS new_name,
  'ALTER INDEX ' || ip.index_owner || '.' || ip.index_name || ' RENAME PARTITION ' || ip.partition_name || ' TO ' || p.partition_name || ';' AS remedy
FROM cat_ind_partitions ip
JOIN cat_part_indexes pi ON pi.db_name = ip.db_name AND pi.owner = ip.index_owner AND pi.index_name = ip.index_name
JOIN cat_tab_partitions p ON p.db_name = pi.db_name AND p.table_owner = pi.owner AND p.table_name = pi.table_name
  AND p.partition_position = ip.partition_position
WHERE ip.partition_name <> p.partition_name AND ip.partition_name NOT LIKE 'SYS_IL%'
  AND p.table_owner NOT IN (SELECT owner FROM cat_internal_owners)""")
def q_index_partition_rename(R):
    return pa.index_partition_rename(R.ind_partitions, R.part_indexes, R.tab_partitions, R.internal_owners)


@register("index_partition_colocate", """
SELECT i.db_name, i.index_owner, i.index_name, i.partition_name,
  'alter index ' || i.index_owner || '.' || i.index_name || ' rebuild partition ' || i.partition_name || ' tablespace ' || t.tablespace_name || ' online;' AS remedy
FROM cat_tab_partitions t
JOIN cat_part_indexes x ON x.db_name = t.db_name AND x.owner = t.table_owner AND x.table_name = t.table_name
JOIN cat_ind_partitions i ON i.db_name = x.db_name AND i.index_owner = x.owner AND i.index_name = x.index_name AND i.partition_name = t.partition_name
WHERE t.tablespace_name <> i.tablespace_name AND t.table_owner IN ('APP')""")
def q_index_partition_colocate(R):
    return pa.index_partition_colocate(R.tab_partitions, R.ind_partitions, R.part_indexes, owners=("APP",))


_POLICY = "(VALUES " + ", ".join(f"('{o}', '{t}', '{p}', {d}, '{'%Y_%m%d' if f == 'yyyy_MMdd' else '%Y_%m'}')" for o, t, p, d, f in RETENTION) + \
    ") AS pol(table_owner, table_name, prefix, days, fmt)"


@register("expired_partitions", f"""
WITH plan AS MATERIALIZED ({_PLAN}),
renamed AS MATERIALIZED (
  SELECT tp.db_name, tp.table_owner, tp.table_name, coalesce(pl.new_name, tp.partition_name) AS partition_name
  FROM cat_tab_partitions tp LEFT JOIN plan pl ON pl.db_name = tp.db_name AND pl.table_owner = tp.table_owner
    AND pl.table_name = tp.table_name AND pl.partition_name = tp.partition_name),
c AS (SELECT *, prefix || CASE fmt WHEN '%Y_%m%d' THEN strftime(CAST(TIMESTAMP '{ORDERS_AS_OF}' AS DATE) - days, '%Y_%m%d')
       ELSE strftime(CAST(TIMESTAMP '{ORDERS_AS_OF}' AS DATE) - days, '%Y_%m') END AS cutoff_name FROM {_POLICY})
SELECT r.db_name, r.table_owner, r.table_name, r.partition_name, c.cutoff_name,
  'alter table ' || r.table_owner || '.' || r.table_name || ' drop partition ' || r.partition_name || ' update global indexes;' AS remedy
FROM renamed r JOIN c ON c.table_owner = r.table_owner AND c.table_name = r.table_name
WHERE starts_with(r.partition_name, c.prefix) AND r.partition_name < c.cutoff_name""")
def q_expired_partitions(R):
    plan = pa.partition_rename_plan(R.tab_partitions, R.part_tables, R.internal_owners)
    renamed = pa.apply_rename(R.tab_partitions, plan)
    policy = R.spark.createDataFrame(RETENTION, pa.POLICY_SCHEMA)
    return pa.expired_partitions(renamed, policy, ORDERS_AS_OF)


@register("missing_tablespaces", f"""
SELECT d.db_name, r.tablespace_name, 'create bigfile tablespace ' || r.tablespace_name || ';' AS remedy
FROM (SELECT DISTINCT db_name FROM cat_databases) d
CROSS JOIN (VALUES {", ".join(f"('{p}_{SUFFIX}')" for p in TS_PREFIXES)}) AS r(tablespace_name)
WHERE NOT EXISTS (SELECT 1 FROM cat_tablespaces t WHERE t.db_name = d.db_name AND t.tablespace_name = r.tablespace_name)""")
def q_missing_tablespaces(R):
    return pa.missing_tablespaces(R.databases, R.tablespaces, TS_PREFIXES, SUFFIX)


_GROUPS = "(VALUES " + ", ".join(f"('{o}', '{p}')" for o, p in sorted(OWNER_GROUPS.items())) + ") AS g(owner, ts_prefix)"
_TARGETS = f"""(SELECT DISTINCT tb.db_name, tb.owner, tb.table_name, g.ts_prefix || '_{SUFFIX}' AS target
  FROM cat_tables tb JOIN {_GROUPS} ON g.owner = tb.owner WHERE tb.partitioned = 'YES')"""


@register("default_tablespace_drift", f"""
SELECT DISTINCT t.db_name, t.owner, t.table_name, t.target,
  'alter table ' || t.owner || '.' || t.table_name || ' MODIFY DEFAULT ATTRIBUTES TABLESPACE ' || t.target || ';' AS remedy
FROM {_TARGETS} t LEFT JOIN cat_part_tables p ON p.db_name = t.db_name AND p.owner = t.owner AND p.table_name = t.table_name
WHERE NOT coalesce(p.def_tablespace_name IN (t.target, 'SHORT_TERM'), false)""")
def q_default_tablespace_drift(R):
    return pa.default_tablespace_drift(R.tables, R.part_tables, OWNER_GROUPS, SUFFIX)


@register("store_in_drift", f"""
SELECT DISTINCT t.db_name, t.owner, t.table_name, t.target,
  'alter table ' || t.owner || '.' || t.table_name || ' set store in (' || t.target || ');' AS remedy
FROM {_TARGETS} t
WHERE NOT EXISTS (SELECT 1 FROM cat_store_lists s WHERE s.db_name = t.db_name AND s.owner = t.owner AND s.table_name = t.table_name
                  AND s.tablespace_name IN (t.target, 'SHORT_TERM'))""")
def q_store_in_drift(R):
    return pa.store_in_drift(R.tables, R.store_lists, OWNER_GROUPS, SUFFIX)


@register("index_default_drift", """
SELECT i.db_name, i.owner, i.index_name, i.table_name,
  'alter index ' || i.owner || '.' || i.index_name || ' MODIFY DEFAULT ATTRIBUTES TABLESPACE ' || t.def_tablespace_name || ';' AS remedy
FROM cat_part_indexes i JOIN cat_part_tables t ON t.db_name = i.db_name AND t.owner = i.owner AND t.table_name = i.table_name
WHERE i.owner NOT LIKE 'SYS%' AND i.index_name NOT LIKE 'SYS%' AND i.def_tablespace_name <> t.def_tablespace_name""")
def q_index_default_drift(R):
    return pa.index_default_drift(R.part_indexes, R.part_tables)


_NO_MV = """NOT EXISTS (SELECT 1 FROM cat_mviews m WHERE m.db_name = {a}.db_name AND m.owner = {a}.{o} AND m.name = {a}.table_name)
  AND NOT EXISTS (SELECT 1 FROM cat_mview_logs m WHERE m.db_name = {a}.db_name AND m.owner = {a}.{o} AND m.name = {a}.table_name)"""
_NO_FBI = """NOT EXISTS (SELECT 1 FROM cat_indexes x WHERE x.index_type LIKE 'FUN%' AND x.db_name = {a}.db_name
  AND x.table_owner = {a}.{o} AND x.table_name = {a}.table_name)"""


@register("row_movement_candidates", f"""
SELECT t.db_name, t.owner, t.table_name, 'alter table ' || t.owner || '."' || t.table_name || '" enable row movement;' AS remedy
FROM cat_tables t
WHERE t.row_movement = 'DISABLED' AND t.iot_type IS NULL AND t.temporary = 'N' AND t.owner NOT LIKE '%SYS%'
  AND t.owner NOT IN ('OUTLN', 'XDB', 'GSMADMIN_INTERNAL', 'GGS') AND t.compression = 'DISABLED'
  AND {_NO_MV.format(a='t', o='owner')}""")
def q_row_movement_candidates(R):
    return pa.row_movement_candidates(R.tables, R.mviews, R.mview_logs)


_SHRINK = f"""SELECT t.db_name, t.owner, t.table_name, t.num_rows,
  'alter table ' || t.owner || '."' || t.table_name || '" shrink space CASCADE;' AS remedy
FROM cat_tables t
WHERE t.row_movement = 'ENABLED' AND t.segment_created = 'YES' AND t.iot_type IS NULL AND t.temporary = 'N'
  AND t.partitioned = 'NO' AND t.compression = 'DISABLED' AND t.read_only = 'NO' AND t.owner NOT LIKE '%SYS%'
  AND t.owner NOT IN ('OUTLN', 'XDB', 'GSMADMIN_INTERNAL', 'GGS', 'VIZ')
  AND {_NO_MV.format(a='t', o='owner')} AND {_NO_FBI.format(a='t', o='owner')}"""


@register("shrink_candidates", _SHRINK)
def q_shrink_candidates(R):
    return pa.shrink_candidates(R.tables, R.mviews, R.mview_logs, R.indexes)


@register("shrink_partition_candidates", f"""
SELECT p.db_name, p.table_owner, p.table_name, p.partition_name, p.num_rows,
  'alter table ' || p.table_owner || '.' || p.table_name || ' modify partition ' || p.partition_name || ' shrink space;' AS remedy
FROM cat_tab_partitions p
WHERE p.segment_created = 'YES' AND p.compression = 'DISABLED' AND p.partition_name NOT LIKE '%0000'
  AND EXISTS (SELECT 1 FROM cat_tables t WHERE t.db_name = p.db_name AND t.owner = p.table_owner AND t.table_name = p.table_name
              AND t.iot_type IS NULL AND t.temporary = 'N' AND t.owner NOT LIKE '%SYS%'
              AND t.owner NOT IN ('OUTLN', 'XDB', 'GSMADMIN_INTERNAL', 'GGS', 'VIZ') AND {_NO_MV.format(a='t', o='owner')})
  AND {_NO_MV.format(a='p', o='table_owner')} AND {_NO_FBI.format(a='p', o='table_owner')}""")
def q_shrink_partition_candidates(R):
    return pa.shrink_partition_candidates(R.tab_partitions, R.tables, R.mviews, R.mview_logs, R.indexes)


@register("exclude_patterns", f"""
SELECT * FROM ({_SHRINK}) s
WHERE NOT ({" OR ".join(f"contains(remedy, '{p}')" for p in EXCLUDE if p.strip())})""")
def q_exclude_patterns(R):
    return pa.exclude_patterns(pa.shrink_candidates(R.tables, R.mviews, R.mview_logs, R.indexes), EXCLUDE)


@register("shrink_candidates_limited", f"""
SELECT db_name, owner, table_name, num_rows, replace(remedy, ' CASCADE;', ' COMPACT;') AS remedy
FROM ({_SHRINK} AND t.num_rows < 50000 AND t.tablespace_name <> 'TS_3') s""")
def q_shrink_candidates_limited(R):
    """The shrink plan with a row limit, a caller's predicate and COMPACT."""
    return pa.shrink_candidates(R.tables, R.mviews, R.mview_logs, R.indexes, max_rows=50000, predicate="tablespace_name <> 'TS_3'",
                                compact=True, cascade=False)
