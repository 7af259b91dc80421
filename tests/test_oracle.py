"""Every registered query against its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as E
from estatelens.plans import registry
from harness import SF_MID, SF_SMALL, compare

# the library's own keys; the training-data operators have tests of their own
QUERIES = {k: q for k, q in E.queries().items() if k in registry.QUERIES}
ORACLE = {k: q for k, q in E.oracle_sql().items() if k in registry.QUERIES}
# keys with more than one join or aggregation over a fact role, compared at the larger scale too
HEAVY = ("dependency_mismatch", "excessive_grants", "health_report", "missing_grant_option", "missing_sequence_grants",
         "reclaimable_space", "reconcile_counts", "stale_dependents", "sync_delta", "tablespace_usage")


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck_small, key):
    df = QUERIES[key](spark, SF_SMALL)
    assert compare(df, duck_small, ORACLE[key]) is None


@pytest.mark.parametrize("key", HEAVY)
def test_heavy_query_matches_oracle_at_mid_scale(spark, duck_mid, key):
    assert compare(QUERIES[key](spark, SF_MID), duck_mid, ORACLE[key]) is None


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "remedy" in df.columns
