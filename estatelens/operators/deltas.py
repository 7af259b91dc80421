"""Changes between a table and its copy, found by a tree of checksums.

A full comparison by key shuffles every column of both tables. Here each side
first adds up a checksum per bucket of keys, in one pass with partial sums; the
checksums of ``fan_out`` neighbouring buckets make one of the next level. The
trees are compared from the top, a level reads only children of nodes that
differ, and only rows of differing buckets meet in the join. With changes in few
buckets the rows that are shuffled are a small part of the tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelens.operators.partitions import sync_delta

LEAVES = 1 << 16
FAN_OUT = 64
SUMS = ("n", "high", "low", "mixed")


def key_bucket(keys, leaves: int = LEAVES) -> Column:
    """Bucket of a row by the hash of its key."""
    return F.pmod(F.xxhash64(*keys), F.lit(leaves)).cast("long")


def _row_hash(df: DataFrame, salt: int) -> Column:
    """Hash of a row; nulls, which the function skips, count by their place."""
    parts = [F.lit(salt), F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in df.columns])]
    return F.xxhash64(*parts, *[F.col(c) for c in df.columns])


def leaf_digests(df: DataFrame, bucket: Column) -> DataFrame:
    """(node, n, high, low, mixed) of every bucket that has rows: row count, both halves of a sum of row hashes, exclusive or of a second hash."""
    df = df.select(*sorted(df.columns))
    h = _row_hash(df, 1)
    rows = df.select(bucket.alias("node"), F.shiftrightunsigned(h, 32).alias("high"), h.bitwiseAND(F.lit(0xFFFFFFFF)).alias("low"), _row_hash(df, 2).alias("mixed"))
    return _add_up(rows.withColumn("n", F.lit(1).cast("long")))


def _add_up(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("node").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low"), F.bit_xor("mixed").alias("mixed"))


def upper_level(nodes: DataFrame, fan_out: int = FAN_OUT) -> DataFrame:
    return _add_up(nodes.withColumn("node", F.floor(F.col("node") / fan_out)))


def differing(a: DataFrame, b: DataFrame, levels: int = 2, fan_out: int = FAN_OUT) -> DataFrame:
    """(node) of the leaves of two ``leaf_digests`` tables that differ, from ``levels`` levels above them downwards."""
    trees = [(a, b)]
    for _ in range(levels):
        trees.append(tuple(upper_level(x, fan_out) for x in trees[-1]))
    found = None
    for x, y in reversed(trees):
        if found is not None:
            parents = found.select(F.col("node").alias("__parent"))
            x, y = (t.join(parents, F.floor(F.col("node") / fan_out) == F.col("__parent"), "left_semi") for t in (x, y))
        y = y.select("node", *[F.col(c).alias(f"{c}_y") for c in SUMS])
        same = reduce(lambda p, q: p & q, [F.col(c).eqNullSafe(F.col(f"{c}_y")) for c in SUMS])
        found = x.join(y, "node", "full_outer").filter(~same).select("node")
    return found


def differing_rows(interim: DataFrame, source: DataFrame, bucket: Column, levels: int = 2) -> tuple[DataFrame, DataFrame]:
    """The rows of both sides that lie in buckets whose checksums differ. ``bucket`` is an expression over the key columns alone."""
    cols = sorted(source.columns)
    leaves = differing(leaf_digests(interim.select(*cols), bucket), leaf_digests(source.select(*cols), bucket), levels).select(F.col("node").alias("__leaf"))
    return tuple(t.join(leaves, bucket == F.col("__leaf"), "left_semi") for t in (interim, source))


def tree_delta(interim: DataFrame, source: DataFrame, keys, bucket: Column | None = None, levels: int = 2) -> DataFrame:
    """``sync_delta`` of the two tables; only rows of differing buckets reach its join.

    Without ``bucket`` keys are spread by hash. Where changes cluster (new keys,
    a month, a tenant), a bucket that keeps neighbouring keys together leaves
    most buckets untouched.
    """
    keys = list(keys)
    bucket = key_bucket(keys) if bucket is None else bucket
    return sync_delta(*differing_rows(interim, source, bucket, levels), keys)


def tree_reconcile(source: DataFrame, copy: DataFrame, bucket: Column, levels: int = 2) -> DataFrame:
    """(node, source_rows, copy_rows) of the buckets whose contents differ."""
    cols = sorted(source.columns)
    a, b = (leaf_digests(t.select(*cols), bucket) for t in (source, copy))
    counts = (t.select("node", F.col("n").alias(c)) for t, c in ((a, "source_rows"), (b, "copy_rows")))
    out = differing(a, b, levels)
    for c in counts:
        out = out.join(c, "node", "left")
    return out.select("node", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("source_rows", "copy_rows")])
