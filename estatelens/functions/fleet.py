"""Fleet-level join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def per_database(df: DataFrame, several: str = "error") -> DataFrame:
    """One row per database (settings, sizes, identity), for broadcast.

    Equal rows of a database (a cluster's instances) become one, so the size is
    bounded by the number of databases in the fleet, not by the data, and no
    join multiplies rows. A database with different rows ends the query with an
    error that names it, unless the caller says which of them counts:
    ``several="smallest"`` takes the first in the order of its columns. A join
    keyed on ``db_name`` alone must never shuffle the large side: all rows of a
    busy database would meet in one task."""
    rest = [c for c in df.columns if c != "db_name"]
    if not rest:
        return F.broadcast(df.distinct())
    if several not in ("error", "smallest"):
        raise ValueError(f"unknown rule {several!r}")
    row = F.struct(*rest)
    one = df.groupBy("db_name").agg(F.min(row).alias("__row"), F.max(row).alias("__last"))
    differ = F.raise_error(F.concat(F.lit("several different rows of database "), F.coalesce("db_name", F.lit("NULL"))))
    checked = F.when(F.col("__row").eqNullSafe(F.col("__last")), F.col("__row")).otherwise(differ.cast(df.select(row).schema[0].dataType))
    one = one.select("db_name", checked.alias("__row")) if several == "error" else one
    return F.broadcast(one.select(*[F.col("__row")[c].alias(c) if c in rest else F.col(c) for c in df.columns]))
