"""The corpus pipeline: language, near-duplicates, personal data, mixture, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; ``run`` writes each result as Parquet to the shared folder and reads it
back as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from estatelens.llm import bpe, langid, mixing, pii, simhash  # noqa: E402
from estatelens.llm.common import scratch, table  # noqa: E402
from estatelens.llm.queries import tokenizer  # noqa: E402

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a language that the network knows."""
    docs = docs.select(*COLUMNS)
    return langid.predict(docs, langid.fit(docs)).filter(langid.accepted()).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays: the one with the smallest id."""
    docs = docs.select(*COLUMNS)
    return simhash.representatives(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; spans of personal data become marks, and n_chars follows where there are any."""
    docs = docs.select(*COLUMNS)
    clean = pii.redact(docs.withColumn("before", F.col("text")))
    return clean.withColumn("n_chars", F.when(F.col("text") != F.col("before"), F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, as often as the mixture selects the block with their first word."""
    docs = docs.select(*COLUMNS)
    mixed = mixing.mix(docs, keep=COLUMNS)
    return mixed.withColumn("again", F.explode(F.expr("array_repeat(0, copies)"))).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of them and of the bytes they decode to."""
    ranks, pattern = tokenizer("byte_bpe_multi_50k.tiktoken")
    decoded = bpe.decode(bpe.encode(docs, ranks, pattern, keep=("doc_id", "lang", "source")), ranks)
    return decoded.select("doc_id", "lang", "source", *bpe.digests(), "ids")


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mixture", mixture), ("tokens", tokens)]
#: A trained network and byte-pair merges are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
