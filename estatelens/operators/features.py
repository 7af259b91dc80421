"""Feature and licence usage.

The option -> feature map is a fixed 49-row constant (broadcast; its size
is bounded by construction). Usage statistics are joined to it by feature
name, reduced to one flag per (database, option), and every option is
listed for every database by exploding the constant option list per
database row (linear in databases; no cross join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelens.functions.sqlcompat import substr1
from estatelens.functions.fleet import per_database

# Licensable option -> usage-statistics feature name, in the
# source's order. One normalised label per option (S25).
OPTION_FEATURES = [
    ("Active Data Guard", "Active Data Guard - Real-Time Query on Physical Standby"),
    ("Advanced Compression", "HeapCompression"),
    ("Advanced Compression", "Backup BZIP2 Compression"),
    ("Advanced Compression", "Backup DEFAULT Compression"),
    ("Advanced Compression", "Backup HIGH Compression"),
    ("Advanced Compression", "Backup LOW Compression"),
    ("Advanced Compression", "Backup MEDIUM Compression"),
    ("Advanced Compression", "Backup ZLIB, Compression"),
    ("Advanced Compression", "SecureFile Compression (user)"),
    ("Advanced Compression", "SecureFile Deduplication (user)"),
    ("Advanced Compression", "Data Guard"),
    ("Advanced Compression", "Oracle Utility Datapump (Export)"),
    ("Advanced Compression", "Oracle Utility Datapump (Import)"),
    ("Advanced Security", "ASO native encryption and checksumming"),
    ("Advanced Security", "Transparent Data Encryption"),
    ("Advanced Security", "Encrypted Tablespaces"),
    ("Advanced Security", "Backup Encryption"),
    ("Advanced Security", "SecureFile Encryption (user)"),
    ("Change Management Pack", "Change Management Pack (GC)"),
    ("Data Masking Pack", "Data Masking Pack (GC)"),
    ("Data Mining", "Data Mining"),
    ("Diagnostic Pack", "Diagnostic Pack"),
    ("Diagnostic Pack", "ADDM"),
    ("Diagnostic Pack", "AWR Baseline"),
    ("Diagnostic Pack", "AWR Baseline Template"),
    ("Diagnostic Pack", "AWR Report"),
    ("Diagnostic Pack", "Baseline Adaptive Thresholds"),
    ("Diagnostic Pack", "Baseline Static Computations"),
    ("Tuning Pack", "Tuning Pack"),
    ("Tuning Pack", "Real-Time SQL Monitoring"),
    ("Tuning Pack", "SQL Tuning Advisor"),
    ("Tuning Pack", "SQL Access Advisor"),
    ("Tuning Pack", "SQL Profile"),
    ("Tuning Pack", "Automatic SQL Tuning Advisor"),
    ("Database Vault", "Oracle Database Vault"),
    ("WebLogic Server Management Pack Enterprise Edition", "EM AS Provisioning and Patch Automation (GC)"),
    ("Configuration Management Pack for Oracle Database", "EM Config Management Pack (GC)"),
    ("Provisioning and Patch Automation Pack for Database", "EM Database Provisioning and Patch Automation (GC)"),
    ("Provisioning and Patch Automation Pack", "EM Standalone Provisioning and Patch Automation Pack (GC)"),
    ("Exadata", "Exadata"),
    ("Label Security", "Label Security"),
    ("OLAP", "OLAP - Analytic Workspaces"),
    ("Partitioning", "Partitioning (user)"),
    ("Real Application Clusters", "Real Application Clusters (RAC)"),
    ("Real Application Testing", "Database Replay: Workload Capture"),
    ("Real Application Testing", "Database Replay: Workload Replay"),
    ("Real Application Testing", "SQL Performance Analyzer"),
    ("Spatial", "Spatial (Not used because this does not differential usage of spatial over locator, which is free)"),
    ("Total Recall", "Flashback Data Archive"),
]
# Features whose use counts only with compression in feature_info.
NETWORK_COMPRESSION_FEATURE = "Data Guard"
DATAPUMP_FEATURES = ("Oracle Utility Datapump (Export)", "Oracle Utility Datapump (Import)")
# Report labels of those features.
DATAPUMP_LABEL = "Data Pump Compression"
NETWORK_COMPRESSION_LABEL = "Data Guard Network Compression"


def option_feature_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(OPTION_FEATURES, "option_name string, name string")


def option_map_coverage(feature_usage: DataFrame) -> DataFrame:
    """The option map with, per mapped feature, how many databases of the
    fleet report that feature at all (0 when none)."""
    spark = feature_usage.sparkSession
    seen = (feature_usage.select("name", "db_name").distinct()
            .groupBy("name").agg(F.count(F.lit(1)).alias("reporting_databases")))
    return (option_feature_map(spark).join(seen, "name", "left")
            .select("option_name", "name",
                    F.coalesce("reporting_databases", F.lit(0)).cast("bigint").alias("reporting_databases")))


def option_names() -> list[str]:
    seen = []
    for o, _ in OPTION_FEATURES:
        if o not in seen:
            seen.append(o)
    return seen


def feature_in_use(as_of: str, days: int = 366, zero_len_is_null: bool = True) -> Column:
    """Usage predicate over one usage-statistics row.

    ``currently_used`` is ORed away in the source, so it plays no part.
    For the export/import features the source reads a zero-length
    substring, which is NULL there, so they never count (S6);
    ``zero_len_is_null=False`` gives '' instead and lets them count.
    """
    fi = F.col("feature_info")
    n = F.col("name")
    recent = F.col("last_usage_date") > F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(days)} DAYS")
    base = (F.col("detected_usages") > 0) & recent & (F.col("total_samples") > 0)
    dg_flag = F.trim(F.substring(fi, F.instr(fi, "Compression used: ") + 18, F.lit(5)))
    dp_flag = F.trim(substr1(fi, 1, 0, zero_len_is_null=zero_len_is_null))
    special = [NETWORK_COMPRESSION_FEATURE, *DATAPUMP_FEATURES]
    cond = (~n.isin(special)
            | ((n == NETWORK_COMPRESSION_FEATURE) & fi.isNotNull() & (dg_flag != "FALSE"))
            | (n.isin(list(DATAPUMP_FEATURES)) & fi.isNotNull() & (dp_flag != "0")))
    return F.coalesce(base & cond, F.lit(False))


def _db_info(databases: DataFrame, instance: DataFrame) -> DataFrame:
    return (databases.select("db_name", "dbid", F.col("name").alias("database_name"))
            .join(instance.groupBy("db_name").agg(F.min_by("version", "instance_name").alias("db_version"),     # first of several instances
                                                  F.min_by("host_name", "instance_name").alias("host_name")), "db_name", "left"))


def option_usage_summary(feature_usage: DataFrame, instance: DataFrame, databases: DataFrame,
                         as_of: str, zero_len_is_null: bool = True) -> DataFrame:
    """YES/NO per option and database; every option is listed."""
    spark = feature_usage.sparkSession
    used = (feature_usage.join(F.broadcast(option_feature_map(spark)), "name", "inner")
            .groupBy("db_name", "option_name")
            .agg(F.max(feature_in_use(as_of, zero_len_is_null=zero_len_is_null).cast("int")).alias("num")))
    universe = databases.select("db_name", F.explode(F.array(*[F.lit(o) for o in option_names()])).alias("option_name"))
    return (universe.join(used, ["db_name", "option_name"], "left")
            .join(per_database(_db_info(databases, instance), several="smallest"), "db_name", "left")
            .select("db_name", "option_name",
                    F.when(F.coalesce("num", F.lit(0)) > 0, "YES").otherwise("NO").alias("used"),
                    "dbid", "database_name", "db_version", "host_name")
            .orderBy("db_name", F.col("used").desc(), "option_name"))


def option_usage_detail(feature_usage: DataFrame, instance: DataFrame, databases: DataFrame,
                        as_of: str, zero_len_is_null: bool = True, ordered: bool = False) -> DataFrame:
    """One row per used feature, relabelled, with dates, counts and report time."""
    spark = feature_usage.sparkSession
    n = F.col("name")
    label = (F.when(n.isin(list(DATAPUMP_FEATURES)), DATAPUMP_LABEL)
             .when(n == NETWORK_COMPRESSION_FEATURE, NETWORK_COMPRESSION_LABEL).otherwise(n))
    f = (feature_usage.filter(feature_in_use(as_of, zero_len_is_null=zero_len_is_null))
         .join(F.broadcast(option_feature_map(spark)), "name", "inner"))
    out = (f.join(per_database(_db_info(databases, instance), several="smallest"), "db_name", "inner")
            .select("db_name", "option_name", F.lit("YES").alias("used"), label.alias("feature"), "version",
                    "currently_used", "detected_usages", "last_usage_date", "total_samples", "last_sample_date",
                    "dbid", "database_name", "db_version", "host_name",
                    F.date_format(F.lit(as_of).cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss").alias("report_time")))
    return out.orderBy("db_name", "option_name", "feature", "version") if ordered else out
