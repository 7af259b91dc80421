"""Hand-made fixtures for operator edge rules."""

import datetime as dt

from pyspark.sql import functions as F

from estatelens.operators import logs as lg
from estatelens.operators import partitions as pa
from estatelens.operators import security as sec
from estatelens.sources import catalog as cat


def test_sequence_default_parsing(spark):
    cols = spark.createDataFrame(
        [("D", "U1", "T1", "c1", '"U9"."S_A".NEXTVAL'),
         ("D", "U1", "T1", "c2", "seq_b.nextval"),
         ("D", "U1", "T1", "c3", "0"),
         ("D", "U1", "T1", "c4", None)],
        "db_name string, owner string, table_name string, column_name string, data_default string")
    got = sorted((r.seq_schema, r.seq_name) for r in sec.sequence_defaults(cols).collect())
    assert got == [("U9", "S_A"), ("unknown", "seq_b")]


def test_missing_sequence_grant_minus_existing(spark):
    cols = spark.createDataFrame([("D", "U1", "T1", '"U9"."S_A".nextval')],
                                 "db_name string, owner string, table_name string, data_default string")
    privs = spark.createDataFrame(
        [("D", "U1", "T1", "G1", "INSERT", "NO"), ("D", "U1", "T1", "G2", "INSERT", "NO"),
         ("D", "U9", "S_A", "G2", "SELECT", "NO")],
        "db_name string, owner string, table_name string, grantee string, privilege string, grantable string")
    rows = sec.missing_sequence_grants(cols, privs).collect()
    assert [r.remedy for r in rows] == ["grant select on U9.S_A to G1;"]


def test_retention_rules_first_match_and_ages(spark):
    as_of = "2024-01-31 00:00:00"
    t0 = dt.datetime(2024, 1, 31)
    files = spark.createDataFrame([
        ("D", "/a/x.trc", False, 0, t0 - dt.timedelta(minutes=361)),    # empty, > 6 h: delete
        ("D", "/a/y.trc", False, 0, t0 - dt.timedelta(minutes=300)),    # empty, < 6 h: nothing
        ("D", "/a/z.trc", False, 10, t0 - dt.timedelta(minutes=11)),    # non-empty > 10 min: truncate
        ("D", "/a/q.xml", False, 5, t0 - dt.timedelta(days=31)),        # 31 whole days: delete
        ("D", "/a/r.xml", False, 5, t0 - dt.timedelta(hours=30)),       # 1 whole day: truncate
        ("D", "/a/s.xml", False, 5, t0 - dt.timedelta(hours=20)),       # 0 whole days: nothing
        ("D", "/a/t.aud", False, 5, t0),                                # audit: delete
        ("D", "/a/d.aud", True, 0, t0),                                 # a directory: nothing
        ("D", "/listener/alert/log_1.xml", False, 5, t0 - dt.timedelta(days=2)),      # listener XML older than a day: delete
        ("D", "/listener/alert/log.xml", False, 5, t0),                               # current listener XML: truncate
        ("D", "/b/listener.log_1.gz", False, 5, t0 - dt.timedelta(days=31)),          # archived listener log: delete
        ("D", "/b/listener.log_2.gz", False, 5, t0 - dt.timedelta(days=30)),          # not old enough: nothing
    ], "db_name string, path string, is_dir boolean, size_bytes long, mtime timestamp_ntz")
    got = {r.path: r.action for r in lg.file_retention_plan(files, as_of).collect()}
    assert got == {"/a/x.trc": "delete", "/a/z.trc": "truncate", "/a/q.xml": "delete",
                   "/a/r.xml": "truncate", "/a/t.aud": "delete", "/listener/alert/log_1.xml": "delete",
                   "/listener/alert/log.xml": "truncate", "/b/listener.log_1.gz": "delete"}


def test_retention_requires_prefix(spark):  # S13
    tp = spark.createDataFrame(
        [("D", "SCOTT", "LOG", "LOG_2023_0101"), ("D", "SCOTT", "LOG", "LOG_2024_0130"),
         ("D", "SCOTT", "LOG", "AAA_OTHER")],
        "db_name string, table_owner string, table_name string, partition_name string")
    pol = spark.createDataFrame([("SCOTT", "LOG", "LOG_", 31, "yyyy_MMdd")], pa.POLICY_SCHEMA)
    got = [r.partition_name for r in pa.expired_partitions(tp, pol, "2024-01-31 00:00:00").collect()]
    assert got == ["LOG_2023_0101"]


def test_exclude_patterns_ignore_blank(spark):
    plan = spark.createDataFrame([("a KEEP",), ("b DROP",)], "remedy string")
    assert plan.transform(lambda d: pa.exclude_patterns(d, ["", "  "])).count() == 2
    assert [r.remedy for r in pa.exclude_patterns(plan, ["DROP", ""]).collect()] == ["a KEEP"]


def test_fleet_select_switches(spark):
    dbs = spark.createDataFrame([("A", "PRIMARY"), ("B", "PHYSICAL STANDBY"), ("C", "PRIMARY")],
                                "db_name string, database_role string")
    params = spark.createDataFrame([("C", "clonedb", "TRUE")], "db_name string, name string, value string")
    df = spark.createDataFrame([("A", 1), ("B", 2), ("C", 3)], "db_name string, v int")
    names = lambda d: sorted(r.db_name for r in d.collect())
    assert names(cat.fleet_select(df, dbs, params)) == ["A"]
    assert names(cat.fleet_select(df, dbs, params, exclude_types=("standby",))) == ["A", "C"]
    assert names(cat.fleet_select(df, dbs, params, listed=["B", "C"], exclude_types=())) == ["B", "C"]


def test_snapshot_diff_null_safe(spark):
    from estatelens.operators.inventory import snapshot_diff
    b = spark.createDataFrame([("k1", None), ("k2", "x"), ("k3", "y")], "k string, a string")
    a = spark.createDataFrame([("k1", None), ("k2", "z"), ("k4", "w")], "k string, a string")
    got = {r.k: r.change for r in snapshot_diff(b, a, ["k"]).collect()}
    assert got == {"k2": "changed", "k3": "removed", "k4": "added"}


def test_reconcile_detects_difference(spark):
    s = spark.createDataFrame([(1, dt.datetime(2020, 1, 5)), (2, dt.datetime(2020, 2, 5))], "k long, d timestamp_ntz")
    c = s.filter(F.col("k") == 1)
    res = {r.grp.month: r.matches for r in pa.reconcile_counts(s, c, by=pa.month_of(F.col("d")), check_cols=["k"]).collect()}
    assert res == {1: True, 2: False}


def test_stale_stats_profile_owners_and_cascade(spark):
    from estatelens.operators import health as h
    tables = spark.createDataFrame(
        [("D", "APPU", "T1", 5, None, "N", "N", "YES"), ("D", "OTHER", "T2", 5, None, "N", "N", "YES"),
         ("D", "APPU", "T3", 5, dt.datetime(2024, 1, 30), "N", "N", "YES")],
        "db_name string, owner string, table_name string, num_rows long, last_analyzed timestamp_ntz, "
        "temporary string, secondary string, segment_created string")
    stats = spark.createDataFrame([("D", "APPU", "T1", None, None), ("D", "OTHER", "T2", None, None),
                                   ("D", "APPU", "T3", None, None)],
                                  "db_name string, owner string, table_name string, partition_name string, "
                                  "stattype_locked string")
    ext = spark.createDataFrame([], "db_name string, owner string, name string")
    owners = spark.createDataFrame([("D", "APPU")], "db_name string, username string")
    rows = h.stale_table_stats(tables, stats, ext, "2024-01-31 00:00:00", owners=owners, cascade=True).collect()
    assert [r.remedy for r in rows] == ["exec DBMS_STATS.GATHER_TABLE_STATS('APPU','\"T1\"',CASCADE=>TRUE);"]


def test_range_copy_units(spark):
    import tempfile
    df = spark.createDataFrame([(1, dt.datetime(2020, 1, 5, 10)), (2, dt.datetime(2020, 3, 9))], "k long, d timestamp_ntz")
    for unit, want in [("month", {dt.date(2020, 1, 1), dt.date(2020, 3, 1)}),
                       ("year", {dt.date(2020, 1, 1)}),
                       ("day", {dt.date(2020, 1, 5), dt.date(2020, 3, 9)})]:
        out = pa.range_partition_copy(df, "d", tempfile.mkdtemp(prefix="copy-") + "/t", part_col="p", unit=unit)
        assert {r.p for r in out.select("p").distinct().collect()} == want
        assert out.count() == 2
