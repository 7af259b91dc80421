"""Checksum trees and versioned tables."""

import glob
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from estatelens.operators import deltas as dl
from estatelens.operators import partitions as pa
from estatelens.sources import versioned

SCHEMA = "k long, a string, b double, m string"


def rows(df):
    return sorted(map(repr, df.collect()))


def table(n=4000):
    r = random.Random(1)
    return [(k, r.choice([None, "x", "y"]), r.choice([None, 1.5, float("nan"), -0.0]), f"m{k // 500}") for k in range(n)]


@pytest.fixture(scope="module")
def both(spark):
    old = table()
    new = [(k, "changed", b, m) if 700 <= k < 720 else (k, a, b, m) for k, a, b, m in old if k not in (5, 6)] + [(9000, None, None, "m18")]
    return spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA)


@pytest.mark.parametrize("bucket", [None, "floor(k / 50)"])
def test_tree_delta_equals_the_full_delta(both, bucket):
    assert rows(dl.tree_delta(*both, ["k"], F.expr(bucket) if bucket else None)) == rows(pa.sync_delta(*both, ["k"]))


def test_few_rows_reach_the_join(both):
    a, b = dl.differing_rows(*both, F.floor(F.col("k") / 50))
    assert a.count() + b.count() < 0.06 * 8000                # buckets 0, 14 and 180 of 80
    plan = dl.tree_delta(*both, ["k"], F.floor(F.col("k") / 50))._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_checksums_tell_what_sums_and_hashes_of_values_miss(spark):
    def differs(x, y):
        x, y = (spark.createDataFrame(t, SCHEMA) for t in (x, y))
        return dl.differing(dl.leaf_digests(x, F.lit(0).cast("long")), dl.leaf_digests(y, F.lit(0).cast("long"))).count()
    assert differs([(1, "x", None, "m")], [(1, None, None, "m")]) == 1
    assert differs([(1, None, None, "x")], [(1, "x", None, None)]) == 1          # nulls change place
    assert differs([(1, "x", 1.0, "m")] * 2, [(2, "x", 1.0, "m")] * 2) == 1      # an exclusive or of pairs is zero
    assert differs([(1, "x", 1.0, "m"), (2, "y", 1.0, "m")], [(2, "y", 1.0, "m"), (1, "x", 1.0, "m")]) == 0
    assert differs([], []) == 0 and differs([], [(1, "x", 1.0, "m")]) == 1


def files(path):
    return {os.path.relpath(f, path) for f in glob.glob(f"{path}/data/**/*.parquet", recursive=True)}


def test_a_change_rewrites_only_what_it_touches(spark, both):
    old, new = both
    path = tempfile.mkdtemp(prefix="estatelens-versioned-")
    versioned.create(old, path, F.col("m"))
    before = files(path)
    delta = pa.sync_delta(old, new, ["k"])
    assert versioned.apply(path, delta, ["k"], F.col("m"), "first")
    got = versioned.read(spark, path)
    assert rows(got.select("k", "a", "b", "m")) == rows(new)
    added = files(path) - before
    assert before <= files(path) and {f.split(os.sep)[2] for f in added} == {"part=m0", "part=m1", "part=m18"}
    live = {r[0].split("/data/")[1] for r in got.select(F.input_file_name()).distinct().collect()}
    assert {f for f in live if f.startswith("initial/")} == {f[5:] for f in before if not f.split(os.sep)[2] in ("part=m0", "part=m1")}
    # again under the same name: nothing happens
    assert not versioned.apply(path, delta, ["k"], F.col("m"), "first") and len(versioned.current(spark, path)) == 8 + 1 + 1
    # the last row of a partition goes, so does the partition
    assert versioned.apply(path, spark.createDataFrame([("delete", 9000, None, None, None)], f"op string, {SCHEMA}"), ["k"], F.col("m"), "second")
    assert versioned.read(spark, path).count() == new.count() - 1 and "m18" not in {r.part for r in versioned.current(spark, path)}


def test_a_row_that_moves_leaves_its_old_partition(spark):
    path = tempfile.mkdtemp(prefix="estatelens-versioned-")
    versioned.create(spark.createDataFrame([(1, "x", 1.0, "p"), (2, "x", 1.0, "p"), (3, "x", 1.0, None)], SCHEMA), path, F.col("m"))
    versioned.apply(path, spark.createDataFrame([("update", 1, "x", 1.0, "q"), ("insert", 4, "y", 1.0, "q")], f"op string, {SCHEMA}"), ["k"], F.col("m"), "move")
    assert sorted((r.k, r.part) for r in versioned.read(spark, path).collect()) == [(1, "q"), (2, "p"), (3, "none"), (4, "q")]


def test_a_run_that_dies_leaves_the_old_state(spark, both, monkeypatch):
    old, new = both
    path = tempfile.mkdtemp(prefix="estatelens-versioned-")
    versioned.create(old, path, F.col("m"))
    delta = pa.sync_delta(old, new, ["k"])

    def die(*_):
        raise KeyboardInterrupt
    with monkeypatch.context() as m:
        m.setattr(versioned, "_publish", die)
        with pytest.raises(KeyboardInterrupt):
            versioned.apply(path, delta, ["k"], F.col("m"), "first")
    assert rows(versioned.read(spark, path).select("k", "a", "b", "m")) == rows(old)
    assert versioned.apply(path, delta, ["k"], F.col("m"), "first")          # the rerun finds the dead run's files and replaces them
    assert rows(versioned.read(spark, path).select("k", "a", "b", "m")) == rows(new)


def test_no_table_yet(spark):
    with pytest.raises(ValueError, match="no table"):
        versioned.read(spark, tempfile.mkdtemp(prefix="estatelens-versioned-"))
