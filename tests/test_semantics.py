"""Unit fixtures for the semantics rows of SURVEY §1.4 and invariants."""

import datetime as dt

from pyspark.sql import functions as F

from estatelens.functions.fleet import per_database
from estatelens.functions.sqlcompat import before_last, number_text, nz_concat, substr1, trunc_toward_zero
from estatelens.operators import capacity as cap
from estatelens.operators import features as fe
from estatelens.operators import health as h
from estatelens.operators import partitions as pa
from estatelens.operators import security as sec
from estatelens.sources.roles import Roles
from harness import SF_SMALL


def test_null_concat_is_empty(spark):  # S1
    r = spark.range(1).select(nz_concat("a", F.lit(None).cast("string"), "b").alias("x")).first()
    assert r.x == "ab"


def test_zero_length_substring_is_null(spark):  # S5, S6
    r = spark.range(1).select(substr1(F.lit("abc"), 0, 2).alias("a"), substr1(F.lit("abc"), 2, 0).alias("b"),
                              substr1(F.lit("abc"), 2, 0, zero_len_is_null=False).alias("c")).first()
    assert (r.a, r.b, r.c) == ("ab", None, "")


def test_trunc_and_before_last(spark):
    r = spark.range(1).select(trunc_toward_zero(F.lit(-2.7)).alias("t"),
                              before_last(F.lit('"u1"."s".nextval'), ".").alias("b"),
                              before_last(F.lit("plain"), ".").alias("n")).first()
    assert (r.t, r.b, r.n) == (-2.0, '"u1"."s"', None)


def test_null_order(spark):  # S2: ASC nulls last, DESC nulls first
    users = spark.createDataFrame(
        [("D", "a", 1, "P", "EXPIRED"), ("D", "b", 2, "P", "EXPIRED"), ("D", "c", 3, "P", "EXPIRED")],
        "db_name string, username string, user_id long, profile string, account_status string")
    hist = spark.createDataFrame([("D", 1, dt.datetime(2020, 1, 1)), ("D", 2, dt.datetime(2021, 1, 1))],
                                 "db_name string, user_id long, password_date timestamp_ntz")
    rows = sec.password_needs_change(users, hist, "P", ordered=True).collect()
    assert [r.username for r in rows] == ["b", "a", "c"]


def test_not_in_with_null_vs_anti_join(spark):  # S3
    a = spark.createDataFrame([("D", "x"), ("D", "y")], "db_name string, tablespace_name string")
    b = spark.createDataFrame([("D", None), ("D", "x")], "db_name string, tablespace_name string")
    a.createOrReplaceTempView("t_a")
    b.createOrReplaceTempView("t_b")
    sql_rows = spark.sql("SELECT * FROM t_a WHERE tablespace_name NOT IN (SELECT tablespace_name FROM t_b)").count()
    anti_rows = a.join(b, ["db_name", "tablespace_name"], "left_anti").count()
    assert sql_rows == 0 and anti_rows == 1


def test_counter_reset(spark):  # S26
    rows = []
    for day, v in [(1, 100), (2, 200), (3, 50), (4, 150)]:
        rows.append(("D", day, 1, dt.datetime(2024, 1, day, 12), "redo size", v * 1048576))
    s = spark.createDataFrame(rows, "db_name string, snap_id long, instance_number int, "
                                    "begin_interval_time timestamp_ntz, stat_name string, value long")
    keep = cap.daily_counter_growth(s, "2024-01-05 00:00:00", trend_days=7, num_days=1).first().estimate_mb
    drop = cap.daily_counter_growth(s, "2024-01-05 00:00:00", trend_days=7, num_days=1,
                                    drop_resets=True).first().estimate_mb
    assert keep == 17 and drop == 100   # avg(100, -150, 100) rounds to 17


def test_missing_day_breaks_pair(spark):
    rows = [("D", i, 1, dt.datetime(2024, 1, d, 1), "redo size", v * 1048576)
            for i, (d, v) in enumerate([(1, 10), (2, 20), (4, 100)])]
    s = spark.createDataFrame(rows, "db_name string, snap_id long, instance_number int, "
                                    "begin_interval_time timestamp_ntz, stat_name string, value long")
    assert cap.daily_counter_growth(s, "2024-01-05 00:00:00", num_days=1).first().estimate_mb == 10


def test_bad_high_value_yields_no_plan(spark):  # S11
    tp = spark.createDataFrame(
        [("D", "APP", "TAR_X", "SYS_P1", 1, "TO_DATE(' 2020-02-01 00:00:00')"),
         ("D", "APP", "TAR_X", "SYS_P2", 2, "garbage"),
         ("D", "APP", "TAR_X", "SYS_P3", 3, "MAXVALUE")],
        "db_name string, table_owner string, table_name string, partition_name string, "
        "partition_position int, high_value string")
    pt = spark.createDataFrame([], "db_name string, owner string, table_name string, interval string")
    io = spark.createDataFrame([("SYS",)], "owner string")
    plan = pa.partition_rename_plan(tp, pt, io).collect()
    assert [(r.partition_name, r.new_name) for r in plan] == [("SYS_P1", "X_2020_01")]


def test_int_month_year_end(spark):
    tp = spark.createDataFrame([("D", "SCOTT", "HISTORY", "SYS_P9", 1, "201913"),
                                ("D", "SCOTT", "HISTORY", "SYS_P8", 2, "20200301")],
                               "db_name string, table_owner string, table_name string, partition_name string, "
                               "partition_position int, high_value string")
    pt = spark.createDataFrame([], "db_name string, owner string, table_name string, interval string")
    io = spark.createDataFrame([("SYS",)], "owner string")
    got = {r.partition_name: r.new_name for r in pa.partition_rename_plan(tp, pt, io).collect()}
    assert got == {"SYS_P9": "HISTORY_2019_12", "SYS_P8": "HISTORY_2020_02"}


def test_datapump_zero_length_rule(spark):  # S6 in the usage predicate
    fu = spark.createDataFrame(
        [("D", "Oracle Utility Datapump (Export)", 3, 1, dt.datetime(2024, 1, 1), "compression used: 3 times")],
        "db_name string, name string, detected_usages long, total_samples long, last_usage_date timestamp_ntz, "
        "feature_info string")
    on = fu.select(fe.feature_in_use("2024-01-31 00:00:00").alias("u")).first().u
    off = fu.select(fe.feature_in_use("2024-01-31 00:00:00", zero_len_is_null=False).alias("u")).first().u
    assert on is False and off is True


def test_used_plus_free_is_real(spark):
    R = Roles(spark, SF_SMALL)
    for r in cap.tablespace_usage(R.data_files, R.extents).collect():
        assert abs(r.used_gb + r.free_gb - r.realsize_gb) <= 0.15


def test_rename_plan_then_apply_is_empty(spark):
    R = Roles(spark, SF_SMALL)
    plan = pa.partition_rename_plan(R.tab_partitions, R.part_tables, R.internal_owners)
    renamed = pa.apply_rename(R.tab_partitions, plan)
    assert plan.count() > 0
    assert pa.partition_rename_plan(renamed, R.part_tables, R.internal_owners).count() == 0


def test_sync_then_apply_is_empty(spark):
    o = Roles(spark, SF_SMALL).driver("orders")
    src = o.filter(F.col("o_orderkey") % 13 != 5)
    interim = o.filter(F.col("o_orderkey") % 10 != 3)
    delta = pa.sync_delta(interim, src, ["o_orderkey"])
    synced = pa.apply_delta(interim, delta, ["o_orderkey"])
    assert delta.count() > 0
    assert pa.sync_delta(synced, src, ["o_orderkey"]).count() == 0


def test_difference_is_disjoint(spark):
    R = Roles(spark, SF_SMALL)
    miss = sec.missing_quota(R.segments, R.sys_privs, R.ts_quotas)
    quota = R.ts_quotas.filter(F.col("max_bytes") == -1).select(
        "db_name", F.col("username").alias("owner"), F.col("tablespace_name").alias("object_name"))
    assert miss.select("db_name", "owner", "object_name").intersect(quota).count() == 0


def test_maintenance_gate_flags(spark):
    R = Roles(spark, SF_SMALL)
    gate = {r.db_name: r for r in h.maintenance_gate(R.databases, R.restore_points, R.parameters).collect()}
    assert gate["DB0"].is_clone and not gate["DB0"].may_run          # clonedb=TRUE
    assert gate["DB2"].reason == "flashback active"                    # flashback YES


def test_every_rename_rule_has_rows(spark):
    R = Roles(spark, SF_SMALL)
    plan = pa.partition_rename_plan(R.tab_partitions, R.part_tables, R.internal_owners)
    assert {r.rule for r in plan.select("rule").distinct().collect()} == {"day", "num3", "interval_num", "int_month", "date_month"}


def test_default_retention_policy(spark):
    tp = spark.createDataFrame([("D", "SCOTT", "LOG", "LOG_2001_0701"), ("D", "SCOTT", "LOG", "LOG_2001_0703"), ("D", "SCOTT", "HISTORY", "HISTORY_2000_07")],
                               "db_name string, table_owner string, table_name string, partition_name string")
    got = {r.partition_name for r in pa.expired_partitions(tp, None, "2001-08-02 00:00:00").collect()}
    assert got == {"LOG_2001_0701", "HISTORY_2000_07"}


def test_footprint_has_three_rows_a_table(spark):
    seg = spark.createDataFrame([("D", "U", "T", "TABLE", 1048576)], "db_name string, owner string, segment_name string, segment_type string, bytes long")
    ix = spark.createDataFrame([], "db_name string, owner string, index_name string, table_owner string, table_name string")
    lobs = spark.createDataFrame([], "db_name string, owner string, segment_name string, table_name string")
    got = {(r.kind, r.mb, r.segments) for r in cap.segment_footprint(seg, ix, lobs).collect()}
    assert got == {("Total Data Segments", 1.0, 1), ("Total Index Segments", None, 0), ("Total LOB Segments", None, 0)}


def test_growth_pairs_only_neighbouring_days(spark):
    rows = [("D", 1, dt.datetime(2024, 1, d, 12), "redo size", v * 1048576) for d, v in ((25, 10), (26, 30), (28, 100), (29, 140))]
    st = spark.createDataFrame(rows, "db_name string, instance_number int, begin_interval_time timestamp_ntz, stat_name string, value long")
    assert cap.daily_counter_growth(st, "2024-01-31 00:00:00", num_days=1).first().estimate_mb == 30


def test_number_text(spark):
    got = spark.createDataFrame([(1234567.25,), (0.05,), (-12.0,), (1e12,), (None,)], "x double").select(
        number_text("x", "999,999,999.9").alias("a"), number_text("x", "FM9999999999999").alias("b"), number_text("x", "9999999.9%").alias("c")).collect()
    assert [r.a for r in got] == ["   1,234,567.3", "            .1", "         -12.0", "#" * 14, None]
    assert [r.b for r in got] == ["1234567", "0", "-12", "1000000000000", None]
    assert [r.c for r in got] == [" 1234567.3%", "        .1%", "     -12.0%", "#" * 10 + "%", None]


def test_per_database_is_one_row(spark):
    df = spark.createDataFrame([("D", "h2", 1), ("D", "h1", 2), ("E", None, 3)], "db_name string, host string, n int")
    assert sorted(map(tuple, per_database(df, several="smallest").collect())) == [("D", "h1", 2), ("E", None, 3)]
    assert sorted(map(tuple, per_database(df.select("db_name")).collect())) == [("D",), ("E",)]


def test_memory_report_text(spark):
    stats = spark.createDataFrame([("D", "a", 1073741824.0, "bytes"), ("D", "b", 7.0, None)], "db_name string, name string, value double, unit string")
    assert [r.value for r in cap.memory_stats(stats, as_text=True).orderBy("name").collect()] == ["       1,024.0", "           7.0"]
