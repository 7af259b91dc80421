"""The FINDING row shape shared by health, security and plan operators:
(rule_id, db_name, owner, object_name, detail, remedy), all STRING."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FINDING_COLUMNS = ["rule_id", "db_name", "owner", "object_name", "detail", "remedy"]
FINDING_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in FINDING_COLUMNS])


def _as_col(v) -> Column:
    if v is None:
        return F.lit(None).cast("string")
    if isinstance(v, str):
        return F.col(v)
    return v


def finding(df: DataFrame, rule_id: str, owner=None, object_name=None,
            detail=None, remedy=None, db_name="db_name") -> DataFrame:
    """Project ``df`` to FINDING. Strings name columns; pass Columns for
    expressions and ``F.lit`` for constants."""
    return df.select(
        F.lit(rule_id).alias("rule_id"),
        _as_col(db_name).cast("string").alias("db_name"),
        _as_col(owner).cast("string").alias("owner"),
        _as_col(object_name).cast("string").alias("object_name"),
        _as_col(detail).cast("string").alias("detail"),
        _as_col(remedy).cast("string").alias("remedy"),
    )


def empty_findings(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], FINDING_SCHEMA)


def not_internal(df: DataFrame, internal_owners: DataFrame, owner_col: str = "owner") -> DataFrame:
    """Drop rows owned by an internal schema. ``internal_owners`` is a
    distinct owner list (one column ``owner``), small by construction: a
    fleet-wide set of built-in schema names."""
    io = internal_owners.select(F.col("owner").alias("__io_owner")).distinct()
    return df.join(F.broadcast(io), F.col(owner_col) == F.col("__io_owner"), "left_anti")
