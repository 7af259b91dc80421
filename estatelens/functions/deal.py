"""Rows dealt over tasks by key."""

from __future__ import annotations

from pyspark.sql import DataFrame


def dealt(df: DataFrame, *keys: str, least: int = 1) -> DataFrame:
    """``df`` hashed by ``keys`` over the session's shuffle partitions, or over ``least`` if those are fewer.

    Adaptive execution merges partitions up to a size in compressed bytes, and
    names of a catalog compress tenfold and more, so what is sorted or hashed
    in one merged task may be many times that size. A number of partitions
    that is given is kept; a join or aggregation on the same keys uses them.
    """
    return df.repartition(max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *keys)
