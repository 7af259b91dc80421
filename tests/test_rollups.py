"""Subtotals, sketches, grant lists, intersections, parsed details, fleet reads."""

import tempfile

import pytest
from pyspark.sql import functions as F

from estatelens.functions.fleet import per_database
from estatelens.operators import health as h
from estatelens.operators import logs as lg
from estatelens.operators import rollups as ru
from estatelens.sources import catalog as cat
from estatelens.sources.roles import Roles
from harness import SF_SMALL


def test_a_null_owner_is_not_a_subtotal(spark):
    df = spark.createDataFrame([("A", "T", None, "TABLE", 5), ("A", "T", "U", "TABLE", 7), (None, "T", "U", "INDEX", 1)],
                               "db_name string, tablespace_name string, owner string, segment_type string, bytes long")
    out = ru.space_rollup(df)
    got = {tuple(r)[:5]: (r.bytes, r.segments) for r in out.collect()}
    assert got["A", "T", None, "TABLE", 0] == (5, 1) and got["A", "T", None, None, 1] == (5, 1) and got["A", "T", None, None, 3] == (12, 2)
    assert got["A", None, None, None, 5] == (5, 1) and got["A", None, None, None, 7] == (12, 2)
    assert got[None, None, None, None, 7] == (1, 1) and got[None, None, None, None, 15] == (13, 3)


def test_subtotals_take_one_scan(spark):
    plan = ru.space_rollup(Roles(spark, SF_SMALL).segments)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Expand" in plan and "partial_sum" in plan


def test_stored_sketches_merge_like_the_union(spark):
    df = spark.range(60_000).select(F.lit("A").alias("db_name"), (F.timestamp_seconds(F.col("id") * 60)).alias("t"), (F.col("id") % 5000).alias("item"), F.col("id").alias("size"))
    daily = ru.daily_sketches(df, "t", F.col("item"), F.col("size"))
    path = tempfile.mkdtemp(prefix="estatelens-sketch-")
    daily.write.mode("overwrite").parquet(path)
    stored = spark.read.parquet(path)
    halves = [ru.merge_sketches(stored.filter(c)) for c in ("day < '1970-01-20'", "day >= '1970-01-20'")]
    for merged in (ru.merge_sketches(stored), ru.merge_sketches(halves[0].unionByName(halves[1]))):
        r = ru.sketch_estimates(merged).first()
        assert r.n == 60_000 and abs(r.distinct_items - 5000) < 0.05 * 5000
        assert abs(r.quantiles[0] - 30_000) < 0.03 * 60_000 and abs(r.quantiles[1] - 57_000) < 0.03 * 60_000


def test_privileges_stand_in_order_and_once(spark):
    rows = [("D", "U", "T", "G", p, "NO") for p in ("UPDATE", "ALTER", "UPDATE", "SELECT")] + [("D", "U", "T", "G", "INSERT", "YES"), ("D", "APEX_1", "T", "G", "SELECT", "NO"), ("D", "SYS", "T", "G", "SELECT", "NO")]
    p = spark.createDataFrame(rows, "db_name string, owner string, table_name string, grantee string, privilege string, grantable string")
    lines = ru.grant_lines(p, spark.createDataFrame([("SYS",)], "owner string"))
    assert sorted(r.line for r in lines.collect()) == ["grant ALTER,SELECT,UPDATE on U.T to G;", "grant INSERT on U.T to G with grant option;"]


def test_intersection_does_not_grow_with_the_fleet(spark):
    dbs = spark.createDataFrame([(f"D{k}",) for k in range(30)], "db_name string")
    rows = [(f"D{k}", n) for k in range(30) for n in ("everywhere", None, f"only{k}")] + [(f"D{k}", "nearly") for k in range(29)] + [("ELSE", "nearly"), ("D0", "everywhere")]
    df = spark.createDataFrame(rows, "db_name string, name string")
    out = ru.in_every_database(df, ["name"], dbs)
    assert sorted(str(r.name) for r in out.select("name").collect()) == ["None", "everywhere"]
    want = df.filter("db_name = 'D0'").select("name")
    for k in range(1, 30):
        want = want.intersect(df.filter(f"db_name = 'D{k}'").select("name"))
    assert out.exceptAll(want).isEmpty() and want.exceptAll(out).isEmpty()
    few = ru.in_every_database(df, ["name"], spark.createDataFrame([("D0",), ("D1",)], "db_name string"))
    size = lambda d: d._jdf.queryExecution().optimizedPlan().toString().count("\n")
    assert abs(size(out) - size(few)) <= 2


def test_details_of_odd_texts(spark):
    texts = ['{"a": 1, "b": "x", "c": null, "d": {"e": [1, 2]}}', '{"a": 1', "{}", "", None, "  ", "plain words", "Compression used: TRUE, level: 3; mode = fast", '{"n": "99999999999999999999"}', "{not json}"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, info string")
    got = sorted((tuple(r) for r in ru.parsed_details(df, "info", ["id"]).collect()), key=lambda r: (r[0], str(r[2])))
    assert got == [
        (0, "json", "a", "1", 1, None, None), (0, "json", "b", "x", None, None, None), (0, "json", "c", None, None, None, None), (0, "json", "d", '{"e":[1,2]}', None, None, None),
        (1, "bad", None, None, None, None, '{"a": 1'), (6, "bad", None, None, None, None, "plain words"),
        (7, "pairs", "Compression used", "TRUE", None, True, None), (7, "pairs", "level", "3", 3, None, None), (7, "pairs", "mode", "fast", None, None, None),
        (8, "json", "n", "99999999999999999999", None, None, None), (9, "bad", None, None, None, None, "{not json}")]


def test_a_synonym_with_a_granted_target_stays(spark):
    s = spark.createDataFrame([("D", "U", "S1", "O", "T1"), ("D", "U", "S2", "O", "T2"), ("D", "PUBLIC", "S3", "O", "T2"), ("E", "U", "S1", "O", "T1")],
                              "db_name string, owner string, synonym_name string, table_owner string, table_name string")
    p = spark.createDataFrame([("D", "O", "T1", "G", "SELECT", "NO")] * 3, "db_name string, owner string, table_name string, grantee string, privilege string, grantable string")
    assert sorted((r.db_name, r.remedy) for r in ru.orphaned_synonyms(s, p).collect()) == [("D", "drop synonym U.S2;"), ("E", "drop synonym U.S1;")]


def test_different_rows_of_one_database_end_the_query(spark):
    df = spark.createDataFrame([("A", 1, None), ("A", 1, None), ("B", 2, "x")], "db_name string, n int, s string")
    assert sorted(tuple(r) for r in per_database(df).collect()) == [("A", 1, None), ("B", 2, "x")]
    with pytest.raises(Exception, match="several different rows of database B"):
        per_database(df.unionByName(spark.createDataFrame([("B", 3, "x")], df.schema))).collect()


def test_the_plan_of_a_fleet_read_does_not_grow(spark):
    path = tempfile.mkdtemp(prefix="estatelens-fleet-")
    df = spark.range(40).select(F.concat(F.lit("D"), F.col("id")).alias("db_name"), "id")
    cat.write_catalog(df, path)
    out = cat.fleet_read(spark, path, df.drop("db_name").schema)
    assert out.count() == 40 and cat.fleet_read(spark, path, df.drop("db_name").schema, ["D3", "D17"]).count() == 2
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_parents_meet_the_dictionary_once(spark):
    R = Roles(spark, SF_SMALL)
    plan = h.dependency_mismatch(R.objects, R.obj_dict, R.obj_dependency)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [db_name") >= 2 and "Cartesian" not in plan


def test_patterns_come_after_cheap_tests(spark):
    plan = lg.file_retention_plan(Roles(spark, SF_SMALL).files, "2024-01-31 00:00:00")._jdf.queryExecution().optimizedPlan().toString()
    at = plan.index("RLIKE")
    assert "Contains" in plan[:at] or "LIKE %" in plan[:at] or "contains" in plan[:at].lower()
