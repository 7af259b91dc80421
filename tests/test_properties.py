"""Property tests of the SQL-compat helpers against Python models of the
source semantics. All generated cases run in one DataFrame per property."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from estatelens.functions.sqlcompat import after_last, before_last, nz_concat, substr1

TEXT = st.text(alphabet="ab._", max_size=8)


def oracle_substr(s, pos, length):
    """Source semantics for pos >= 0: position 0 acts as 1; a length <= 0
    gives NULL (the helper is not used with negative positions)."""
    if s is None:
        return None
    if length is not None and length <= 0:
        return None
    start = max(pos, 1) - 1
    return s[start:] if length is None else s[start:start + length]


@settings(max_examples=1, deadline=None)
@given(st.lists(st.tuples(TEXT, st.integers(0, 6), st.integers(0, 5)), min_size=40, max_size=40))
def test_substr1_matches_model(spark, cases):
    df = spark.createDataFrame([(s, p, n) for s, p, n in cases], "s string, p int, n int")
    exprs = [substr1(F.col("s"), p, n).alias(f"c{i}") for i, (_, p, n) in enumerate(cases)]
    row_by_case = df.select("s", *exprs).collect()
    for i, (s, p, n) in enumerate(cases):
        assert row_by_case[i][f"c{i}"] == oracle_substr(s, p, n), (s, p, n)


@settings(max_examples=1, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), min_size=30, max_size=30))
def test_last_separator_split_matches_model(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", before_last(F.col("t"), ".").alias("b"), after_last(F.col("t"), ".").alias("a")).collect()
    for r in rows:
        t = r.t
        if t is None:
            assert r.b is None and r.a is None
        elif "." in t:
            assert (r.b, r.a) == (t.rsplit(".", 1)[0], t.rsplit(".", 1)[1])
        else:
            assert (r.b, r.a) == (None, t)


@settings(max_examples=1, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), TEXT), st.one_of(st.none(), TEXT)), min_size=30, max_size=30))
def test_nz_concat_treats_null_as_empty(spark, pairs):
    df = spark.createDataFrame(pairs, "x string, y string")
    for r in df.select("x", "y", nz_concat(F.col("x"), "-", F.col("y")).alias("z")).collect():
        assert r.z == (r.x or "") + "-" + (r.y or "")
