"""Edition hierarchy, interval and as-of joins: cycles, ties, long intervals, plans."""

import datetime as dt
import random

from pyspark.sql import functions as F

from estatelens.operators import editions as ed
from estatelens.operators import temporal as tm


def test_levels_of_chains_ends_and_cycles(spark):
    rows = [("A", "ORA$BASE", None), ("A", "lone", None), ("A", "below_lone", "lone"), ("A", "orphan", "gone"), ("A", "self", "self"), ("A", "under_self", "self"),
            ("A", "x", "y"), ("A", "y", "z"), ("A", "z", "x"), ("A", "tail", "x"), ("B", "e1", "ORA$BASE"), ("B", "ORA$BASE", None), ("B", "ORA$BASE", None)]
    rows += [("A", f"c{k}", f"c{k - 1}" if k else "ORA$BASE") for k in range(300)]
    got = {(r.db_name, r.edition_name): (r.level, r.state) for r in ed.edition_levels(spark.createDataFrame(rows, "db_name string, edition_name string, parent_edition_name string")).collect()}
    assert len(got) == len(set(r[:2] for r in rows))
    assert all(got["A", f"c{k}"] == (k + 2, "deployed") for k in range(300))
    assert got["A", "ORA$BASE"] == (1, "deployed") and got["B", "e1"] == (2, "deployed")
    assert all(got["A", n] == (None, "detached") for n in ("lone", "below_lone", "orphan"))
    assert all(got["A", n] == (None, "cycle") for n in ("self", "under_self", "x", "y", "z", "tail"))


def test_levels_without_rows(spark):
    assert ed.edition_levels(spark.createDataFrame([], "db_name string, edition_name string, parent_edition_name string")).count() == 0


def test_a_default_edition_must_exist(spark):
    e = spark.createDataFrame([("A", "E1", None)], "db_name string, edition_name string, parent_edition_name string")
    p = spark.createDataFrame([("A", "DEFAULT_EDITION", "E1"), ("B", "DEFAULT_EDITION", "E1"), ("A", "OTHER", "E1")], "db_name string, property_name string, property_value string")
    assert [tuple(r) for r in ed.default_edition(e, p).collect()] == [("A", "E1")]


def spans(seed, n):
    r = random.Random(seed)
    out = [(k, r.choice("AB"), s := r.randint(-500, 500), s + r.choice([0, 1, 2, 5, 8, 64, 65, 700, -3])) for k in range(n)]
    return out + [(n, "A", -10 ** 15, 10 ** 15), (n + 1, "A", None, 5), (n + 2, None, 0, 5), (n + 3, "B", 3, 4), (n + 4, "B", 3, 4)]


def test_interval_join_equals_the_inequality(spark):
    a, b = spans(1, 150), spans(2, 170)
    schema = "id long, db_name string, s long, e long"
    for unit in (1, 7, 1000):
        j = tm.interval_join(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), ("s", "e"), ("s", "e"), unit=unit)
        got = sorted((r.l.id, r.r.id) for r in j.collect())
        ok = lambda x: None not in x and x[2] < x[3]
        assert got == sorted((x[0], y[0]) for x in a for y in b if ok(x) and ok(y) and x[1] == y[1] and x[2] < y[3] and y[2] < x[3])


def test_interval_join_has_no_nested_loop(spark):
    schema = "id long, db_name string, s timestamp_ntz, e timestamp_ntz"
    t = dt.datetime(2024, 1, 1)
    f = spark.createDataFrame([(1, "A", t, t + dt.timedelta(days=400)), (2, "A", t, t + dt.timedelta(seconds=1))], schema)
    j = tm.interval_join(f, f, ("s", "e"), ("s", "e"))
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert j.count() == 4
    one = tm._placed(tm._levelled(f.filter("id = 1"), "s", "e", 60_000_000, "l"), "l", F.array("l_level"), 60_000_000)
    assert one.count() <= 2                                   # 400 days do not become 576,000 minutes


def test_asof_join_equals_a_loop(spark):
    r = random.Random(4)
    readings = [(r.choice("AB"), r.randint(0, 300), k % 5, f"v{k % 7}") for k in range(120)] + [("A", None, 1, "never")] + [("A", 50, 4, "tie"), ("A", 50, 4, "tie"), ("A", 50, 4, "zz")]
    events = [(k, r.choice("ABC"), r.randint(-20, 2000) if k % 9 else None) for k in range(200)]
    rs, es = spark.createDataFrame(readings, "db_name string, t long, seq int, v string"), spark.createDataFrame(events, "id long, db_name string, at long")
    for width in (10, 100_000):
        got = {x.id: tuple(x.reading) if x.reading else None for x in tm.asof_join(es, rs, "at", "t", ties=("seq",), slice_width=width).collect()}
        want = {}
        for k, db, at in events:
            before = [x for x in readings if at is not None and x[0] == db and x[1] is not None and x[1] <= at]
            want[k] = max(before, key=lambda x: (x[1], x[2], x[0], x[3])) if before else None
        assert got == want


def test_asof_windows_are_dealt_by_slice(spark):
    rs, es = spark.createDataFrame([("A", 1, 1)], "db_name string, t long, seq int"), spark.createDataFrame([(1, "A", 1)], "id long, db_name string, at long")
    plan = tm.asof_join(es, rs, "at", "t")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [last") == 2 and "__slice" in plan
