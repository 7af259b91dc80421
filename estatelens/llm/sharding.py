"""Sharding by extendible hashing, DataFrame functions only.

The directory is indexed by leading bits of a row's hash. A bucket over the
byte limit splits on its next bit, and only such buckets do. Byte sums per
hash prefix are made once for ``STEP`` bits and rolled up to every shorter prefix;
prefixes that are still too large after these bits go through the next ``STEP``
bits alone. A shard is named by its bits ("" is the whole table).

Rows that no bit can part (all ``HASH_BITS`` bits equal, as for repeated rows)
stay in one bucket; it is cut into numbered pages of whole rows below the limit.
A single row over the limit is a page of its own.

Defined results: null text is 0 bytes; null doc_id hashes as the empty string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estatelens.llm.common import scratch

#: Bytes of text in one shard.
LIMIT_BYTES = 16 * 1024 * 1024
#: Bits looked at in one round: a round rolls up at most 2 ** 12 sums for each bucket that is still open.
STEP = 12
#: 15 hex digits of the hash.
HASH_BITS = 60
#: Parts in which rows that share all bits of the hash are numbered.
SALTS = 64


def hash_bits(doc_id: Column) -> Column:
    """The first 60 bits of the md5 of the id as a string of 0 and 1."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, HASH_BITS // 4)
    return F.lpad(F.conv(digits, 16, 2), HASH_BITS, "0")


def directory(rows: DataFrame, limit: int = LIMIT_BYTES) -> DataFrame:
    """prefix, depth, shard_bytes: the buckets, from rows (bits, bytes). They cover every row once."""
    done, open_rows, depth = None, rows, 0
    while depth < HASH_BITS:
        top = min(depth + STEP, HASH_BITS)
        leaf = open_rows.groupBy(F.substring("bits", 1, top).alias("leaf")).agg(F.sum("bytes").alias("bytes"))
        level = leaf.select(F.explode(F.sequence(F.lit(depth), F.lit(top))).alias("depth"), "leaf", "bytes")
        level = level.groupBy("depth", F.expr("substring(leaf, 1, depth)").alias("prefix")).agg(F.sum("bytes").alias("shard_bytes"))
        parent = level.filter(F.col("shard_bytes") > limit).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        level = level.withColumn("parent", F.expr("substring(prefix, 1, depth - 1)"))
        # a bucket lives where its parent was too large; the roots of this round were too large in the last one
        here = scratch(level.join(parent, ["depth", "parent"], "left_semi").unionByName(level.filter(F.col("depth") == depth))
                       .select("prefix", "depth", "shard_bytes"), f"directory-{depth}")
        fits = (F.col("shard_bytes") <= limit) | (F.col("depth") == HASH_BITS)
        done = here.filter(fits) if done is None else done.unionByName(here.filter(fits))
        large = here.filter(~fits & (F.col("depth") == top)).select("prefix")
        if top == HASH_BITS or large.isEmpty():
            break
        open_rows = open_rows.withColumn("prefix", F.substring("bits", 1, top)).join(large, "prefix", "left_semi").select("bits", "bytes")
        depth = top
    return done


def shard(docs: DataFrame, limit: int = LIMIT_BYTES, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, bytes, shard (its bits), depth, shard_bytes and page of every row of ``docs`` (doc_id, text)."""
    rows = scratch(docs.select(*[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)], hash_bits(F.col("doc_id")).alias("bits"),
                               F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"),
                               F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).alias("salt")), "shard")       # written, so a rerun task sees the same
    buckets = scratch(directory(rows, limit), "buckets")
    # A row's bucket is the one whose bits begin its hash: an equality for each depth that occurs (60 at most).
    depths = [r.depth for r in buckets.select("depth").distinct().orderBy("depth").collect()]
    any_depth = F.explode(F.array(*[F.struct(F.lit(d).alias("depth"), F.substring("bits", 1, d).alias("prefix")) for d in depths])) if depths else F.lit(None)
    if not depths:
        return rows.select(*[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)], "bytes", F.lit("").alias("shard"), F.lit(0).alias("depth"),
                           "bytes", F.lit(0).cast("long").alias("page")).toDF(*keep, "bytes", "shard", "depth", "shard_bytes", "page")
    placed = rows.withColumn("b", any_depth).select("*", "b.depth", "b.prefix").drop("b").join(buckets, ["depth", "prefix"])
    # Rows that share all bits of the hash: salted numbering, so that a hot id is not one task.
    whole = placed.filter((F.col("depth") < HASH_BITS) | (F.col("shard_bytes") <= limit)).withColumn("page", F.lit(0).cast("long"))
    same = placed.filter((F.col("depth") == HASH_BITS) & (F.col("shard_bytes") > limit))
    part = Window.partitionBy("prefix", "salt").orderBy("bytes")
    room = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(F.lit(1), F.max("bytes").over(Window.partitionBy("prefix", "salt")))))
    same = same.withColumn("page", (F.floor((F.row_number().over(part) - 1) / room) * SALTS + F.col("salt")).cast("long"))
    return whole.unionByName(same).select(*[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)], "bytes", F.col("prefix").alias("shard"), "depth",
                                          "shard_bytes", "page")
