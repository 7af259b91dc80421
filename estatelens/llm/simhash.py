"""SimHash near-duplicates by segment-popcount embedding.

Fingerprints are made per document in Arrow batches; equal fingerprints become
one row. Counting the set bits of every 2-bit segment embeds a fingerprint in a
grid of 32 dimensions with values 0 to 2. A differing bit changes one count by
one, so the Manhattan distance of two points is at most their bit distance.

Grid range join for distance 3: of the two halves (16 dimensions each) one is
within Manhattan distance 1. In that half two points lie in one cell or in
cells one step apart, so each point probes its own cell and one step up in each
dimension. Pairs that meet are held against the bound over all 32 dimensions
and then verified bit by bit.

Defined results: null and empty texts have no words and fingerprint zero, which
links like any other; null doc_ids get the component of their fingerprint;
a component without any doc_id has a null id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estatelens.llm.common import prepare, scratch
from estatelens.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
#: Shingles hashed and counted at once; bounds the memory of a very long text.
BLOCK = 16_384
#: Low bit of every 2-bit segment of a half.
LOW = 0x55555555


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash over word shingles; bytes.split and bytes.lower touch ASCII only, as the word pattern does."""
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    joined = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), dtype="i8", count=len(w)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(w) - words + 1)
    a, z = starts[:n].tolist(), ends[min(words, len(w)) - 1:].tolist()
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, dtype="i8")
    for lo in range(0, n, BLOCK):
        h = np.array([digest(joined[s:e], SEED) for s, e in zip(a[lo:lo + BLOCK], z[lo:lo + BLOCK])], dtype="<u8")
        total += np.unpackbits(h.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype="i8")
    return int(np.packbits(total * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """Every row of ``docs`` as a struct ``row`` of its columns, and ``fp``, the fingerprint of its text as a signed long."""
    prepare(docs.sparkSession)
    at = docs.columns.index("text")
    rows = docs.select(F.struct("*").alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, words) for t in b.column(0).flatten()[at].to_pylist()], dtype="u8").view("i8")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], ["row", "fp"])
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("fp", T.LongType())]))


def popcounts(half: Column) -> Column:
    """Bit counts of the sixteen 2-bit segments of a 32-bit half, as sixteen 2-bit fields."""
    return half - F.shiftright(half, 1).bitwiseAND(F.lit(LOW))


def manhattan(a: Column, b: Column) -> Column:
    """Manhattan distance of two packed points with fields 0 to 2: xor gives 01 or 11 for a step of one, 10 for two."""
    x = a.bitwiseXOR(b)
    low = x.bitwiseAND(F.lit(LOW))
    high = F.shiftright(x, 1).bitwiseAND(F.lit(LOW))
    return F.bit_count(low) + 2 * F.bit_count(high.bitwiseAND(F.bitwise_not(low)))


def halves(fps: DataFrame) -> DataFrame:
    mask = F.lit(0xFFFFFFFF)
    return fps.select("fp", popcounts(F.col("fp").bitwiseAND(mask)).alias("p0"), popcounts(F.shiftrightunsigned("fp", 32)).alias("p1"))


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """a, b: every pair of the distinct fingerprints at most ``max_bits`` (up to 3) apart, once."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the grid serves bit distances 0 to 3")
    p = halves(fps)
    ups = [F.when(F.shiftright("cell", 2 * i).bitwiseAND(F.lit(3)) < 2, F.col("cell") + F.lit(1 << 2 * i)) for i in range(16)]
    home = p.select("*", F.explode(F.array(F.struct(F.lit(0).alias("half"), F.col("p0").alias("cell")), F.struct(F.lit(1).alias("half"), F.col("p1").alias("cell")))).alias("h"))
    home = home.select("fp", "p0", "p1", "h.half", "h.cell")
    probe = home.withColumn("reach", F.explode(F.filter(F.array(F.col("cell"), *ups), lambda c: c.isNotNull())))
    a, b = probe.alias("a"), home.alias("b")
    near0, near1 = manhattan(F.col("a.p0"), F.col("b.p0")), manhattan(F.col("a.p1"), F.col("b.p1"))
    pairs = a.join(b, (F.col("a.half") == F.col("b.half")) & (F.col("a.reach") == F.col("b.cell")))
    once = (F.col("a.reach") != F.col("a.cell")) | (F.col("a.fp") < F.col("b.fp"))
    new = (F.col("a.half") == 0) | (near0 > 1)            # the second half adds what the first has not met
    bound = near0 + near1 <= max_bits
    exact = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits
    return pairs.filter(once & new & bound & exact).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))


def classes(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """fp and component (its smallest fingerprint) of the distinct fingerprints in ``fps``."""
    groups = components(links(fps, max_bits))
    return fps.join(groups, fps.fp == groups.node, "left").select("fp", F.coalesce("component", "fp").alias("component"))


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of ``docs`` (doc_id, text)."""
    made = fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), words)
    rows = scratch(made.select("row.doc_id", "fp"), "fingerprints")
    fps = scratch(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    fps = scratch(fps.join(classes(fps.select("fp"), max_bits), "fp"), "grouped")
    least = fps.groupBy("component").agg(F.min("least").alias("component_id"))
    fps = scratch(fps.join(least, "component").select("fp", "component_id"), "labelled")
    return rows.join(fps, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: the smallest doc_id, null ones last, then the smallest hash of the text.

    Only ids, text hashes and fingerprints go through the join and the
    components. The texts are shuffled once, by (id, hash), where repeated rows
    become one before the shuffle and the chosen rows are picked after it.
    """
    key = (F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text").alias("hash"))
    made = fingerprints(docs.select("text", F.struct(*key).alias("key")), words)
    rows = scratch(made.select("row.key", "fp"), "fingerprints")
    fps = scratch(rows.groupBy("fp").agg(F.min("key").alias("first")), "distinct")
    chosen = fps.join(classes(fps.select("fp"), max_bits), "fp").groupBy("component").agg(F.min("first").alias("first"))
    chosen = scratch(chosen.select("first.*"), "chosen")
    unique = docs.select(*key, F.struct("*").alias("row")).groupBy("none", "id", "hash").agg(F.first("row").alias("row"))
    return unique.join(chosen.hint("merge"), ["none", "id", "hash"], "left_semi").select("row.*")
