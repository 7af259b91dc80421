"""Streaming versions of the log archive and the redo-rate monitor.

Both read files as they arrive, keep progress in a checkpoint under the
shared checkpoint dir (so a restarted or re-run job picks up where it
stopped and never writes a file twice) and write through the file sink.
``available_now=True`` processes what is there and stops, which is how a
scheduled run (the source's cron) uses them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from estatelens.functions.deal import dealt
from estatelens.functions.fleet import per_database

ARCHIVED_LOG_SCHEMA = T.StructType([
    T.StructField("db_name", T.StringType()),
    T.StructField("recid", T.LongType()),
    T.StructField("completion_time", T.TimestampNTZType()),
    T.StructField("blocks", T.LongType()),
    T.StructField("block_size", T.LongType()),
    T.StructField("deleted", T.StringType()),
    T.StructField("is_recovery_dest_file", T.StringType()),
])

LOG_SEP = "\t"
#: Input splits whose lines of one database and month go to one archive file.
SPLITS_A_FILE = 2


def format_log_line(db_name, ts, line):
    """Input line layout the archive stream reads: db, timestamp, text."""
    return F.concat_ws(LOG_SEP, db_name, F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"), line)


def stream_archive_logs(spark: SparkSession, in_dir: str, out_path: str, checkpoint: str,
                        available_now: bool = True, compression: str | None = None):
    """Append each new log file's lines once to the monthly archive
    (``db_name=<db>/month=<yyyy-MM>`` text files). A line that does not have
    the layout is kept whole under ``db_name=malformed/month=unknown``."""
    src = spark.readStream.format("text").load(in_dir)
    parts = F.split(F.col("value"), LOG_SEP, 3)
    month = F.date_format(F.try_to_timestamp(F.get(parts, 1)), "yyyy-MM")
    good = (F.size(parts) == 3) & month.isNotNull()
    out = src.select(F.when(good, F.get(parts, 2)).otherwise(F.col("value")).alias("line"),
                     F.when(good, F.get(parts, 0)).otherwise("malformed").alias("db_name"),
                     F.when(good, month).otherwise("unknown").alias("month"),
                     F.floor(F.spark_partition_id() / SPLITS_A_FILE).alias("part"))
    # a group is one task for every few input splits, so a batch writes few files and a hot month is not one task
    out = dealt(out, "db_name", "month", "part").drop("part")
    w = (out.writeStream.format("text").outputMode("append")
         .option("checkpointLocation", checkpoint).partitionBy("db_name", "month"))
    if compression:
        w = w.option("compression", compression)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(out_path)


def redo_rate_windows(archived_log: DataFrame, watermark: str = "1 hour", hours: int = 6) -> DataFrame:
    """Sliding ``hours``-hour windows, one per hour, of redo written into
    the recovery area; rows arriving later than ``watermark`` behind the
    newest event are dropped and each window is final once emitted."""
    ev = (archived_log
          .filter((F.col("deleted") == "NO") & (F.col("is_recovery_dest_file") == "YES"))
          .select("db_name", F.col("completion_time").cast("timestamp_ltz").alias("event_time"),
                  (F.col("blocks") * F.col("block_size")).alias("bytes")))
    return (ev.withWatermark("event_time", watermark)
            .groupBy("db_name", F.window("event_time", f"{hours} hours", "1 hour"))
            .agg(F.sum("bytes").alias("redo_bytes"))
            .select("db_name",
                    F.col("window.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("window.end").cast("timestamp_ntz").alias("window_end"),
                    "redo_bytes", (F.col("redo_bytes") / hours).alias("redo_bytes_per_hour")))


def with_runway(windows: DataFrame, recovery_dest: DataFrame) -> DataFrame:
    """Add the hours of runway each window's rate leaves in the recovery
    area (stream-static join on the per-database sizes)."""
    free = F.col("space_limit") - F.col("space_used") - F.col("space_reclaimable")
    return (windows.join(per_database(recovery_dest.select("db_name", "space_limit", "space_used",
                                                           "space_reclaimable")), "db_name", "left")
            .select("db_name", "window_start", "window_end", "redo_bytes", "redo_bytes_per_hour",
                    F.round(F.try_divide(free, F.col("redo_bytes_per_hour")), 1).alias("runway_hours")))


def stream_redo_rate(spark: SparkSession, in_dir: str, out_path: str, checkpoint: str,
                     watermark: str = "1 hour", hours: int = 6, available_now: bool = True,
                     recovery_dest: DataFrame | None = None):
    """Redo rate per database over sliding windows, appended to Parquet
    as windows close (after the watermark passes); with ``recovery_dest``
    each window also carries the runway it leaves."""
    src = spark.readStream.schema(ARCHIVED_LOG_SCHEMA).parquet(in_dir)
    out = redo_rate_windows(src, watermark, hours)
    if recovery_dest is not None:
        out = with_runway(out, recovery_dest)
    w = (out.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(out_path)
