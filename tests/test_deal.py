"""Steps that keep to many tasks, whatever their compressed size, and shuffle few copies of rows."""

import datetime as dt
import os
import re
from collections import Counter
from types import SimpleNamespace

from pyspark.sql import functions as F

from estatelens.operators import health as h
from estatelens.operators import objects as ob
from estatelens.operators import partitions as pa
from estatelens.operators import security as sec
from estatelens.operators import temporal as tm
from estatelens.plans import q_temporal as qt
from estatelens.streaming import jobs


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_few_long_intervals_do_not_copy_the_other_side(spark):
    short = [(k, "A", k * 60, k * 60 + 40 + k % 300) for k in range(400)]
    left = short + [(1000, "A", 0, 100_000), (1001, None, 0, 5)]
    a, b = (spark.createDataFrame(x, "id long, db_name string, s long, e long") for x in (left, short))
    j = tm.interval_join(a, b, ("s", "e"), ("s", "e"), unit=60)
    assert _plan(j).count("Join Inner") == 1              # one level for all, so one join
    got = sorted((r.l.id, r.r.id) for r in j.collect())
    assert got == sorted((x[0], y[0]) for x in left for y in short if x[1] == y[1] and x[2] < y[3] and y[2] < x[3])


def test_file_ranges_are_not_broadcast(spark):
    files = [("D", 1, 6400), ("D", 1, 6400), ("D", 2, 700), ("D", None, 640), ("D", 3, None)]
    extents = [("D", f, b, n) for f in (1, 2, 3, None) for b, n in ((0, 50), (630, 20), (600, 1400), (6399, 9), (100, 0), (None, 5))] * 2
    f = qt.q_extent_file_ranges(SimpleNamespace(data_files=spark.createDataFrame(files, "db_name string, file_id long, blocks long"),
                                                extents=spark.createDataFrame(extents, "db_name string, file_id long, block_id long, blocks long")))
    extents_in, used = Counter(), Counter()
    for _, file, blocks in (x for x in files if None not in x):
        for k in range(-(-blocks // 640)):
            for _, of, b, n in (x for x in extents if None not in x):
                if of == file and n > 0 and b < (k + 1) * 640 and k * 640 < b + n:
                    extents_in[file, k] += 1
                    used[file, k] += min(b + n, (k + 1) * 640) - max(b, k * 640)
    assert sorted((r.file_id, r.range_no, r.extents, r.blocks_used) for r in f.collect()) == sorted((*k, n, used[k]) for k, n in extents_in.items())
    assert "BroadcastHashJoin" not in _executed(f)


def test_more_rows_of_an_interval_join_are_more_tasks(spark, monkeypatch):
    rows = [(k, "A", k * 37 - 4000, k * 37 - 4000 + k % 90) for k in range(300)] + [(300, "A", -5000, 9000), (301, "A", None, 5), (302, None, 0, 5)]
    f = spark.createDataFrame(rows, "id long, db_name string, s long, e long")
    monkeypatch.setattr(tm, "ROWS_OF_A_TASK", 10, raising=False)
    j = tm.interval_join(f, f, ("s", "e"), ("s", "e"), unit=60)
    assert int(re.search(r"RepartitionByExpression \[.*\], (\d+)", _plan(j))[1]) >= 60
    ok = [x for x in rows if None not in x and x[2] < x[3]]
    assert sorted((r.l.id, r.r.id) for r in j.collect()) == sorted((x[0], y[0]) for x in ok for y in ok if x[2] < y[3] and y[2] < x[3])


def test_times_of_a_pair_are_not_cast_again(spark):
    t = dt.datetime(2024, 1, 1)
    at = lambda k: t + dt.timedelta(seconds=k)
    outages = [("D", k, at(k * 50), at(k * 50 + k % 70)) for k in range(60)] + [("D", 60, at(0), at(90_000)), ("D", 61, None, t), (None, 62, t, at(9))]
    windows = [("D", k, at(k * 40 - k % 200), at(k * 40)) for k in range(60)] * 2 + [("D", None, t, at(9)), ("E", 5, t, at(9))]
    f = qt.q_outage_log_overlap(SimpleNamespace(outages=spark.createDataFrame(outages, "db_name string, outage_id long, started timestamp_ntz, ended timestamp_ntz"),
                                                log_windows=spark.createDataFrame(windows, "db_name string, recid long, first_time timestamp_ntz, next_time timestamp_ntz")))
    want = [(o[1], w[1], (min(o[3], w[3]) - max(o[2], w[2])) // dt.timedelta(microseconds=1)) for o in outages for w in windows
            if o[0] == w[0] and o[2] and o[2] < w[3] and w[2] < o[3] and o[2] < o[3] and w[2] < w[3]]
    assert sorted(map(str, want)) == sorted(str((r.outage_id, r.recid, r.overlap_micros)) for r in f.collect())
    of_pairs = _plan(f).split(":- ")[0]
    assert "Join Inner" in of_pairs and "cast(" not in of_pairs and "unix_micros" not in of_pairs


def test_grantees_of_a_sequence_are_dealt_before_they_are_compared(spark):
    cols = [("D", "U", f"T{k % 3}", f"{q}.nextval") for k in range(6) for q in (f"s{k}", "u.shared", f"u.s{k}")] + [("D", "U", "T0", None), (None, "U", "T0", "u.x.nextval")]
    privs = [("D", "U", f"T{t}", g, "INSERT") for t in range(3) for g in ("a", "b", None)] + [("D", "U", "SHARED", "a", "SELECT"), ("D", "U", "S1", "b", "SELECT")]
    c = spark.createDataFrame(cols * 2, "db_name string, owner string, table_name string, data_default string")
    p = spark.createDataFrame(privs * 2, "db_name string, owner string, table_name string, grantee string, privilege string")
    f = sec.missing_sequence_grants(c, p)
    need = {("U", n, g) for n in [f"S{k}" for k in range(6)] + ["SHARED"] for g in ("a", "b", None)} | {("unknown", f"s{k}", g) for k in range(6) for g in ("a", "b", None)}
    assert sorted(map(str, need - {("U", "SHARED", "a"), ("U", "S1", "b")})) == sorted(str((r.owner, r.object_name, r.detail)) for r in f.collect())
    assert "RepartitionByExpression" in _plan(f)


def test_tables_meet_materialized_views_in_many_tasks(spark):
    t = spark.createDataFrame([("D", o, f"T{k}", "DISABLED", None, "N", "DISABLED") for k in range(6) for o in ("U", "V")] + [("D", "U", None, "DISABLED", None, "N", "DISABLED")],
                              "db_name string, owner string, table_name string, row_movement string, iot_type string, temporary string, compression string")
    m = spark.createDataFrame([("D", "U", "T1")] * 2, "db_name string, owner string, name string")
    logs = spark.createDataFrame([("D", "V", "T2"), ("D", None, "T3")], m.schema)
    f = pa.row_movement_candidates(t, m, logs)
    assert sorted((r.owner, str(r.table_name)) for r in f.collect()) == sorted([(o, f"T{k}") for k in range(6) for o in ("U", "V") if (o, k) not in (("U", 1), ("V", 2))] + [("U", "None")])
    assert "BroadcastHashJoin" not in _executed(f) and "RepartitionByExpression" in _plan(f)


def test_foreign_key_indexes_are_not_broadcast(spark):
    cons = spark.createDataFrame([("D", "U", "PK", "P", "T0", None, None)] * 2 + [("D", "U", "FK", "R", "T1", "U", "PK"), ("D", "U", "LOST", "R", "T2", "U", "GONE")],
                                 "db_name string, owner string, constraint_name string, constraint_type string, table_name string, r_owner string, r_constraint_name string")
    cc = spark.createDataFrame([("D", "U", "PK", "T0", "ID", 1), ("D", "U", "FK", "T1", "REF", 1), ("D", "U", "FK", "T1", "MORE", 2), ("D", "U", "LOST", "T2", "REF", 1)],
                               "db_name string, owner string, constraint_name string, table_name string, column_name string, position int")
    ic = spark.createDataFrame([("D", "U", f"IX_{t}_{c}", "U", t, c, p) for t in ("T0", "T1", "T2") for c, p in (("REF", 1), ("MORE", 2), ("ID", 1))],
                               "db_name string, index_owner string, index_name string, table_owner string, table_name string, column_name string, column_position int")
    assert [tuple(r) for r in ob.fk_indexes(ic, cons, cc).collect()] == [("D", "U", "IX_T1_REF")]
    usage = spark.createDataFrame([("D", "U", n, "NO") for n in ("IX_T1_REF", "IX_T1_MORE", "IX_T1_MORE", "OLD")] + [("D", "U", "ON", "YES"), ("D", "U", None, "NO")], "db_name string, owner string, index_name string, monitoring string")
    f = ob.restart_monitoring(usage, ic, cons, cc)
    assert sorted(str(r.index_name) for r in f.collect()) == ["IX_T1_MORE", "None", "OLD"]
    assert _plan(f).count("RepartitionByExpression") >= 4
    assert _executed(f).count("BroadcastHashJoin") <= 1        # at most the few key columns of the indexed tables


def test_an_archive_batch_is_written_by_many_tasks_in_few_files(spark, tmp_path):
    rows = [("DB1", dt.datetime(2024, 1 + k % 12, 2, 3), f"line {k}") for k in range(240)]
    lines = spark.createDataFrame(rows, "db_name string, ts timestamp_ntz, line string")
    lines.select(jobs.format_log_line(F.col("db_name"), F.col("ts"), F.col("line")).alias("value")).coalesce(1).write.text(str(tmp_path / "in"))
    jobs.stream_archive_logs(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    files = [(d, f) for d, _, names in os.walk(tmp_path / "out") for f in names if f.startswith("part-")]
    assert len(files) == 12                                     # a month of one split is one file
    assert len({f.split("-")[1] for _, f in files}) > 1         # and the months are not one task
    assert spark.read.text(str(tmp_path / "out")).count() == 240


def test_dictionary_joins_of_the_report_keep_to_many_tasks(spark):
    t = dt.datetime(2024, 1, 1)
    later = t + dt.timedelta(days=1)
    objects = spark.createDataFrame([("D", "U", f"O{k}", k, "VIEW", "VALID", "E1") for k in (1, 2, 3)] * 2 + [("D", "U", "TR", 9, "TRIGGER", "INVALID", None)],
                                    "db_name string, owner string, object_name string, object_id long, object_type string, status string, edition_name string")
    entries = spark.createDataFrame([("D", k, "U", f"O{k}", 4, 1, t, None) for k in (1, 2, 3)], "db_name string, obj_id long, owner string, name string, type_id int, status int, stime timestamp_ntz, subname string")
    edges = spark.createDataFrame([("D", 2, 1, t, 1), ("D", 3, 1, later, 1), (None, 2, 1, later, 1)], "db_name string, d_obj long, p_obj long, p_timestamp timestamp_ntz, property long")
    stale, mismatch = h.stale_dependents(objects, entries, edges), h.dependency_mismatch(objects, entries, edges)
    assert sorted(r.object_name for r in stale.collect()) == ["O3", "O3"]
    assert sorted(r.object_name for r in mismatch.collect()) == ["O1", "O3"]
    triggers = spark.createDataFrame([("D", "U", "TR", "ENABLED", "T"), ("D", "U", "OK", "ENABLED", "T")], "db_name string, owner string, trigger_name string, status string, table_name string")
    broken = h.broken_triggers(triggers, objects)
    assert [r.object_name for r in broken.collect()] == ["TR"]
    dp = spark.createDataFrame([("D", "U", n, "NOT RUNNING", "EXPORT", "FULL", 0) for n in ("O1", "gone")], "db_name string, owner_name string, job_name string, state string, operation string, job_mode string, attached_sessions long")
    jobs_left = h.leftover_jobs(dp, objects)
    assert sorted((r.object_name, r.remedy) for r in jobs_left.collect()) == [("O1", "drop table U.O1;"), ("gone", None)]
    assert [_plan(f).count("RepartitionByExpression") for f in (stale, mismatch, broken, jobs_left)] == [4, 4, 1, 1]
