"""Writers. All paths are shared storage (e.g. below the
session's checkpoint dir). ``write_inventory`` and ``write_report`` replace
the partitions they write, so running them again changes nothing;
``append_metrics`` appends, so a batch must be given to it once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_inventory(df: DataFrame, kind: str, path: str) -> None:
    """One sorted distinct line set per kind and database. Sorting is
    within each database's partition (no global sort); a database with no
    lines writes nothing. Only the (kind, database) partitions written are
    replaced."""
    (df.select("db_name", "line").distinct()
       .hint("rebalance", "db_name")              # hot databases split over tasks
       # partition column first, or the writer sorts anew; a constant kind column would have that effect too
       .sortWithinPartitions("db_name", "line")
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("db_name").parquet(f"{path}/kind={kind}"))


def read_inventory(spark, path: str) -> DataFrame:
    return spark.read.schema("line string, kind string, db_name string").parquet(path)


def write_report(findings: DataFrame, path: str, run_ts: str) -> None:
    """Findings filed under database and run time (``yyyyMMddHHmmss``)."""
    (findings.withColumn("run_ts", F.lit(run_ts))
        .hint("rebalance", "db_name")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("db_name", "run_ts").parquet(path))


def append_metrics(df: DataFrame, path: str, ts_col: str = "reading_ts") -> None:
    """Append timestamped readings, partitioned by day."""
    (df.withColumn("dt", F.to_date(F.col(ts_col)))
       .hint("rebalance", "dt")
       .write.mode("append").partitionBy("dt").parquet(path))
