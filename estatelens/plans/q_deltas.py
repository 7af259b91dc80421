"""Registered queries over checksum trees and versioned tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from estatelens.operators import deltas as dl
from estatelens.operators import partitions as pa
from estatelens.plans.q_partitions import _DELTA, _INTERIM, _SRC, orders_interim, orders_source
from estatelens.plans.registry import register
from estatelens.sources import catalog as cat
from estatelens.sources import versioned


def _bucket():
    return F.floor(F.col("o_orderkey") / 64)


@register("tree_sync_delta", _DELTA)
def q_tree_sync_delta(R):
    o = R.driver("orders")
    return dl.tree_delta(orders_interim(o), orders_source(o), ["o_orderkey"], bucket=_bucket())


@register("tree_reconcile", f"""
WITH s AS (SELECT CAST(floor(o_orderkey / 64.0) AS BIGINT) AS node, count(*) AS source_rows FROM {_SRC} x GROUP BY 1),
c AS (SELECT CAST(floor(o_orderkey / 64.0) AS BIGINT) AS node, count(*) AS copy_rows FROM {_INTERIM} x GROUP BY 1),
changed AS (SELECT DISTINCT CAST(floor(o_orderkey / 64.0) AS BIGINT) AS node FROM ({_DELTA}) d)
SELECT node, coalesce(source_rows, 0) AS source_rows, coalesce(copy_rows, 0) AS copy_rows FROM changed LEFT JOIN s USING (node) LEFT JOIN c USING (node)""")
def q_tree_reconcile(R):
    o = R.driver("orders")
    return dl.tree_reconcile(orders_source(o), orders_interim(o), _bucket())


@register("merge_delta", f"SELECT *, strftime(o_orderdate, '%Y-%m') AS part FROM {_SRC} s")
def q_merge_delta(R):
    """The copy, stored by month, after the delta: rows and partitions of the source."""
    o, keys, month = R.driver("orders"), ["o_orderkey"], F.date_format("o_orderdate", "yyyy-MM")
    path = cat.scratch_path(R.spark, "versioned")
    versioned.create(orders_interim(o), path, month)
    versioned.apply(path, pa.sync_delta(orders_interim(o), orders_source(o), keys), keys, month, "sync")
    return versioned.read(R.spark, path)
