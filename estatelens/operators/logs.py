"""Logs, files and redo-rate history."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from estatelens.functions.fleet import per_database

HOUR_MICROS = 3600 * 1000000


def _hour_index(ts: Column) -> Column:
    """Whole hours since the epoch of a zone-less timestamp."""
    return F.floor(F.unix_micros(ts.cast("timestamp_ltz")) / HOUR_MICROS).cast("bigint")


def redo_rate_history(recovery_dest: DataFrame, archived_log: DataFrame, hours: int = 6) -> DataFrame:
    """One reading per database and clock hour with redo: the redo rate
    of the trailing ``hours`` hourly buckets (hour h covers [h, h+1)) and
    the runway it leaves, read at the end of the hour.

    The log is reduced to hourly sums first (partial aggregation), so the
    trailing window runs over at most 24 rows per database and day."""
    hourly = (archived_log
              .filter((F.col("deleted") == "NO") & (F.col("is_recovery_dest_file") == "YES"))
              .groupBy("db_name", _hour_index(F.col("completion_time")).alias("hr"))
              .agg(F.sum(F.col("blocks") * F.col("block_size")).alias("redo_bytes")))
    w = Window.partitionBy("db_name").orderBy("hr").rangeBetween(-(hours - 1), 0)
    rate = hourly.withColumn("redo_bytes_per_hour", F.sum("redo_bytes").over(w) / hours)
    free = F.col("space_limit") - F.col("space_used") - F.col("space_reclaimable")
    lim = F.col("space_limit")
    return (rate.join(per_database(recovery_dest), "db_name", "inner")
            .select("db_name",
                    F.timestamp_micros((F.col("hr") + 1) * HOUR_MICROS).cast("timestamp_ntz").alias("reading_ts"),
                    F.round(F.try_divide(F.col("space_used"), lim) * 100, 0).alias("pct_used"),
                    F.round(F.try_divide(F.col("space_used") - F.col("space_reclaimable"), lim) * 100, 0).alias("pct_logical"),
                    F.round("redo_bytes_per_hour", 1).alias("redo_bytes_per_hour"),
                    F.round(F.try_divide(free, F.col("redo_bytes_per_hour")), 1).alias("runway_hours")))


def latest_reading(metrics: DataFrame) -> DataFrame:
    """Last reading per database, runway also in days (the source's -r mode)."""
    last = F.max_by(F.struct("pct_used", "pct_logical", "runway_hours"), F.col("reading_ts"))
    return (metrics.groupBy("db_name")
            .agg(F.max("reading_ts").alias("reading_ts"), last.alias("r"))
            .select("db_name", "reading_ts", "r.pct_used", "r.pct_logical", "r.runway_hours",
                    (F.col("r.runway_hours") / 24).alias("runway_days")))


def log_month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def archive_logs_by_month(log_lines: DataFrame, path: str, compression: str | None = None) -> None:
    """Append log text to a monthly archive per database: text files under
    ``db_name=<db>/month=<yyyy-MM>``, optionally compressed (e.g. gzip), in
    time order inside each file. Appends: a batch must be given once."""
    w = (log_lines.select("db_name", log_month(F.col("ts")).alias("month"), "ts", "line")
         .hint("rebalance", "db_name", "month").sortWithinPartitions("db_name", "month", "ts")
         .select("line", "db_name", "month")
         .write.mode("append").partitionBy("db_name", "month"))
    if compression:
        w = w.option("compression", compression)
    w.text(path)


def read_log_archive(spark, path: str) -> DataFrame:
    return spark.read.schema("value string, db_name string, month string").text(path) \
        .withColumnRenamed("value", "line")


@dataclass(frozen=True)
class RetentionRule:
    """A file matches when its path ends with ``suffix``, fits ``pattern`` (a
    regular expression found in the path) and size/age fit.
    ``min_age_minutes`` compares the exact age (find -mmin);
    ``min_age_days`` compares whole days of age (find -mtime)."""
    suffix: str
    action: str
    empty: bool | None = None            # True: size 0, False: size > 0, None: any
    min_age_minutes: int | None = None
    min_age_days: int | None = None
    pattern: str | None = None
    contains: str = ""                   # plain text that every match of ``pattern`` holds


def default_retention_rules(keep_days: int = 30) -> list[RetentionRule]:
    # The source's cleanup rules, first match wins.
    return [
        RetentionRule("", "delete", min_age_days=1, pattern=r"/listener/.*/log[^/]*\.xml[^/]*$", contains="/listener/"),
        RetentionRule(".xml", "truncate", pattern=r"/listener/.*/log[^/]*\.xml$", contains="/listener/"),
        RetentionRule("", "delete", min_age_days=keep_days, pattern=r"/listener[^/]*$", contains="/listener"),
        RetentionRule(".aud", "delete"),
        RetentionRule(".trc", "delete", empty=True, min_age_minutes=360),
        RetentionRule(".trm", "delete", empty=True, min_age_minutes=360),
        RetentionRule(".trc", "truncate", empty=False, min_age_minutes=10),
        RetentionRule(".trm", "truncate", empty=False, min_age_minutes=10),
        RetentionRule(".xml", "delete", min_age_days=30),
        RetentionRule(".xml", "truncate", min_age_days=0),
        RetentionRule(".tgz", "delete", min_age_days=keep_days),
    ]


def file_retention_plan(files: DataFrame, as_of: str, rules=None) -> DataFrame:
    """Action per file from the first matching rule; files no rule
    matches are not listed. The rules compile to one JVM-side CASE."""
    rules = default_retention_rules() if rules is None else rules
    age_min = (F.unix_micros(F.lit(as_of).cast("timestamp_ntz").cast("timestamp_ltz"))
               - F.unix_micros(F.col("mtime").cast("timestamp_ltz"))) / 60000000.0
    age_days = F.floor(age_min / 1440)
    action = rule_no = None
    for i, r in enumerate(rules, 1):
        # cheap tests first; Spark keeps the order of AND, so a pattern is tried only where they hold
        c = ~F.col("is_dir")
        if r.suffix:
            c = c & F.col("path").endswith(r.suffix)
        if r.empty is True:
            c = c & (F.col("size_bytes") == 0)
        elif r.empty is False:
            c = c & (F.col("size_bytes") > 0)
        if r.min_age_minutes is not None:
            c = c & (age_min > r.min_age_minutes)
        if r.min_age_days is not None:
            c = c & (age_days > r.min_age_days)
        if r.pattern is not None:
            if r.contains:
                c = c & F.col("path").contains(r.contains)
            c = c & F.col("path").rlike(r.pattern)
        action = F.when(c, r.action) if action is None else action.when(c, r.action)
        rule_no = F.when(c, i) if rule_no is None else rule_no.when(c, i)
    return (files.withColumn("action", action).withColumn("rule", rule_no)
            .filter(F.col("action").isNotNull())
            .select("db_name", "path", "size_bytes", "mtime", "action", "rule"))
