"""Token ids as shuffled, compressed planes with a chunk index.

``write(docs, path)`` encodes every text, appends the end id and writes the
stream of ids in ascending ``doc_id`` order. A data set has two tables:

* ``chunks``: one row per block of ``chunk_ids`` ids of a shard. The block is
  transposed into byte planes (plane k holds byte k of every id) or bit planes;
  each plane is one zstandard frame. The row also lists the documents whose
  ids lie in the block.
* ``index``: shard, chunk, position of the first id, number of ids and plane
  sizes, without the planes.

Shards are the range partitions of ``doc_id``; a long document runs over as
many chunks as it needs. ``read(spark, path)`` restores the documents from the
planes alone. Parquet carries the rows, so Spark's commit protocol and any
store that Spark reaches apply.

Defined results: a null or empty text is the end id alone; null ``doc_id``
comes first; rows of one ``doc_id`` are ordered by the hash of their text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from estatelens.llm.bpe import file_batches
from estatelens.llm.common import larger, prepare

#: Ids in one chunk: 256 kB before compression.
CHUNK_IDS = 65_536
ZSTD_LEVEL = 3
CHUNKS = ("shard int, chunk int, first bigint, n_ids int, planes array<binary>, "
          "seg_doc array<bigint>, seg_no array<bigint>, seg_begin array<int>, seg_len array<int>")


def split_planes(ids: np.ndarray, bits: bool = False) -> list[bytes]:
    """Byte planes (4) or bit planes (32) of unsigned 32-bit ids."""
    rows = np.ascontiguousarray(ids, dtype="<u4").view("u1").reshape(-1, 4)
    if bits:
        rows = np.unpackbits(rows, axis=1, bitorder="little")
        return [np.packbits(p).tobytes() for p in rows.T]
    return [np.ascontiguousarray(p).tobytes() for p in rows.T]


def join_planes(planes: list[bytes], n: int) -> np.ndarray:
    """Inverse of ``split_planes``; 32 planes are bits, 4 are bytes."""
    if len(planes) == 32:
        bit = np.stack([np.unpackbits(np.frombuffer(p, "u1"), count=n) for p in planes], axis=1)
        return np.packbits(bit, axis=1, bitorder="little").view("<u4").reshape(-1)
    return np.stack([np.frombuffer(p, "u1") for p in planes], axis=1).reshape(-1).view("<u4")


def write(docs: DataFrame, path: str, tokenizer: str, pattern: str, end_id: int = 0, chunk_ids: int = CHUNK_IDS, bits: bool = False) -> None:
    """Encode ``docs`` (doc_id, text) and write the data set below ``path``.

    The range shuffle carries the text, not the ids: Spark samples the keys in
    a pass of its own, which would otherwise encode everything twice.
    """
    spark = docs.sparkSession
    prepare(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, pack = file_batches(tokenizer, pattern), zstandard.ZstdCompressor(level=ZSTD_LEVEL)
        end = np.array([end_id], dtype="<u4").tobytes()
        shard = TaskContext.get().partitionId()
        held, size, chunk, number = [], 0, 0, 0        # held: (doc_id, number, bytes of ids)

        def block(take: int) -> pa.RecordBatch:
            """The first ``take`` ids that are held."""
            nonlocal held, size, chunk
            rest, doc, no, begin, length, at = [], [], [], [], [], 0
            data = []
            for d, k, x in held:
                room = (take - at) * 4
                if room > 0:
                    data.append(x[:room])
                    doc.append(d), no.append(k), begin.append(at), length.append(len(data[-1]) // 4)
                    at += length[-1]
                if len(x) > max(room, 0):
                    rest.append((d, k, x[max(room, 0):]))
            ids = np.frombuffer(b"".join(data), "<u4")
            planes = [pack.compress(p) for p in split_planes(ids, bits)]
            row = [[shard], [chunk], [chunk * chunk_ids], [len(ids)], [planes], [doc], [no], [begin], [length]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.int64()),
                     pa.list_(pa.int32()), pa.list_(pa.int32())]
            held, size, chunk = rest, size - len(ids), chunk + 1
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)],
                                              ["shard", "chunk", "first", "n_ids", "planes", "seg_doc", "seg_no", "seg_begin", "seg_len"])

        for b in larger(batches):
            for d, ids in zip(b.column(0).to_pylist(), enc(b.column(1))):
                held.append((d, number, ids + end))
                number += 1
                size += len(held[-1][2]) // 4
                while size >= chunk_ids:
                    yield block(chunk_ids)
        if size:
            yield block(size)

    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.xxhash64("text").alias("tie"))
            .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text"))
    rows.mapInArrow(run, CHUNKS).write.parquet(f"{path}/chunks")
    (spark.read.schema(CHUNKS).parquet(f"{path}/chunks")
     .select("shard", "chunk", "first", "n_ids", F.transform("planes", F.octet_length).alias("plane_bytes"))
     .write.parquet(f"{path}/index"))


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo the CRC-32 polynomial, lowest power at the highest bit."""
    out = 0
    for k in range(31, -1, -1):
        if a >> k & 1:
            out ^= b
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return out


def join_crc(first: int, second: int, second_bytes: int) -> int:
    """crc32 of two strings end to end, from the crc32 of each: the first is moved on by x to the 8 n."""
    power, base, n = 1 << 31, 1 << 23, second_bytes
    while n:
        if n & 1:
            power = _times(power, base)
        base, n = _times(base, base), n >> 1
    return _times(power, first) ^ second


def segments(spark: SparkSession, path: str) -> DataFrame:
    """shard, seg_no, at (position in the shard), doc_id, ids (binary) of every document part, restored from the planes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            for r in b.to_pylist():
                raw = np.ascontiguousarray(join_planes([unpack.decompress(p) for p in r["planes"]], r["n_ids"]), dtype="<u4").tobytes()
                n = len(r["seg_no"])
                parts = [raw[4 * s:4 * (s + k)] for s, k in zip(r["seg_begin"], r["seg_len"])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["shard"]] * n, pa.int32()), pa.array(r["seg_no"], pa.int64()),
                     pa.array([r["first"] + s for s in r["seg_begin"]], pa.int64()), pa.array(r["seg_doc"], pa.int64()), pa.array(parts, pa.binary())],
                    ["shard", "seg_no", "at", "doc_id", "ids"])
    prepare(spark)
    return spark.read.schema(CHUNKS).parquet(f"{path}/chunks").mapInArrow(run, "shard int, seg_no bigint, at bigint, doc_id bigint, ids binary")


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """shard, base: ids in all shards before. One row per shard, from the index."""
    totals = spark.read.parquet(f"{path}/index").groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    @F.pandas_udf("long")
    def joined(crcs: pd.Series, sizes: pd.Series) -> pd.Series:
        out = []
        for c, n in zip(crcs, sizes):
            crc = int(c[0])
            for x, k in zip(c[1:], n[1:]):
                crc = join_crc(crc, int(x), int(k))
            out.append(crc)
        return pd.Series(out, dtype="int64")

    part = F.struct("at", F.crc32("ids").alias("crc"), F.octet_length("ids").cast("long").alias("size"))
    docs = (segments(spark, path).select("shard", "seg_no", "doc_id", part.alias("part"))
            .groupBy("shard", "seg_no").agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list("part")).alias("parts")))
    return (docs.join(shard_starts(spark, path), "shard")
            .select("doc_id", (F.col("base") + F.col("parts")[0]["at"]).alias("start"),
                    (F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["size"]) / 4).cast("long").alias("n_tokens"),
                    joined(F.col("parts.crc"), F.col("parts.size")).alias("ids_crc32")))
