"""The thin opN queries: each applies its operator to the whole of its table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelens.llm import align, ann, bitplanes, bpe, embed_dedup, html_extract, langid, mixing, pii, repair, sharding, simhash, suffix_dedup
from estatelens.llm.common import scratch_path, table

#: Folder of the tokenizer files; unset: the installed package that carries them.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR")


def tokenizer(name: str) -> tuple[str, str]:
    """Path of a tokenizer file and the pattern that cuts text into pieces."""
    import public_tokenizers

    return (os.path.join(TOKENIZERS, name) if TOKENIZERS else public_tokenizers.path(name)), public_tokenizers.PATTERN


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = tokenizer("byte_bpe_multi_50k.tiktoken")
    tokens = bpe.encode(table(spark, sf_dir, "documents"), ranks, pattern)
    return bpe.decode(tokens, ranks).select("doc_id", *bpe.digests())


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op3_bitplanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "bitplanes")
    bitplanes.write(table(spark, sf_dir, "documents"), path, *tokenizer("byte_bpe_50k.json"))
    return bitplanes.read(spark, path)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("copies")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"))


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs.select("doc_id", "text"), langid.fit(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")[:1])


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damage(table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_byte_bpe, op2_sharding, op3_bitplanes, op4_mixing, op5_pii, op6_html, op7_ann, op8_langid, op9_simhash, op10_embed_dedup, op11_suffix_dedup, op12_alignment, op13_repair)}


def sharding_sql(limit: int = sharding.LIMIT_BYTES) -> str:
    """Plain directory: byte sums of every prefix length; a bucket fits where its parent does not. Pages of rows equal in all bits are beyond it."""
    return f"""WITH d AS (
  SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS bytes,
    lpad(bin(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, {sharding.HASH_BITS // 4}) AS BIGINT)), {sharding.HASH_BITS}, '0') AS bits
  FROM documents),
levels AS MATERIALIZED (
  SELECT CAST(t.depth AS INTEGER) AS depth, substr(d.bits, 1, t.depth) AS shard, CAST(sum(d.bytes) AS BIGINT) AS shard_bytes
  FROM d, range(0, {sharding.HASH_BITS + 1}) t(depth) GROUP BY 1, 2),
leaves AS MATERIALIZED (
  SELECT f.* FROM levels f LEFT JOIN levels p ON p.depth = f.depth - 1 AND p.shard = substr(f.shard, 1, f.depth - 1)
  WHERE (f.shard_bytes <= {limit} OR f.depth = {sharding.HASH_BITS}) AND (f.depth = 0 OR p.shard_bytes > {limit}))
SELECT d.doc_id, d.bytes, l.shard, l.depth, l.shard_bytes, CAST(0 AS BIGINT) AS page
FROM d JOIN leaves l ON substr(d.bits, 1, l.depth) = l.shard"""


#: The other queries need a trained network, XXH64, byte-pair merges, code point positions or a search.
ORACLE: dict[str, str] = {"op2_sharding": sharding_sql()}
