"""Capacity and space.

Large inputs are ``extents``, ``segments``, ``archived_log`` and
``sysstat``; each is aggregated to (db_name, key) granularity *before* it
meets another table, so joins only ever see per-file / per-tablespace /
per-database rows. One-row-per-database inputs (parameters,
recovery_dest) are joined on ``db_name``; AQE turns those joins into
broadcasts from their measured size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from estatelens.functions.findings import finding
from estatelens.functions.sqlcompat import number_text, nz_concat, quoted, trunc_toward_zero
from estatelens.functions.fleet import per_database

MB = 1024 * 1024
GB = 1024 * MB

# The storage class of a data file follows its path prefix
# (first four characters); any other prefix is the engineered system.
STORAGE_PREFIX = {"/u03": "ZFS"}
STORAGE_DEFAULT = "EXA"
# Fixed value: maxbytes of a file that autoextends to "unlimited" (32 GiB - 1 block).
UNLIMITED_MAXBYTES = 34359721984


def _storage_class(file_name: Column, prefix_map=None, default=STORAGE_DEFAULT) -> Column:
    prefix_map = STORAGE_PREFIX if prefix_map is None else prefix_map
    p = F.substring(file_name, 1, 4)
    expr = None
    for k, v in prefix_map.items():
        expr = F.when(p == k, v) if expr is None else expr.when(p == k, v)
    return F.lit(default) if expr is None else expr.otherwise(default)


def _user_tablespace(ts: Column) -> Column:
    """Not an undo or system tablespace."""
    return ~ts.like("UNDO%") & ~ts.like("SYS%")


def block_size(parameters: DataFrame) -> DataFrame:
    """(db_name, block_size) from the ``db_block_size`` parameter."""
    return (parameters.filter(F.col("name") == "db_block_size")
            .select("db_name", F.col("value").try_cast("bigint").alias("block_size")))


# ------------------------------------------------------------ tablespaces

def tablespace_usage(data_files: DataFrame, extents: DataFrame, prefix_map=None) -> DataFrame:
    """Real size (maxbytes if autoextensible), used, free and % free per
    tablespace, with storage class and file count; ordered by % free."""
    real = (data_files
            .groupBy("db_name", "tablespace_name")
            .agg(F.sum(F.when(F.col("autoextensible") == "YES", F.col("maxbytes"))
                       .otherwise(F.col("bytes"))).alias("real_bytes"),
                 F.max(_storage_class(F.col("file_name"), prefix_map)).alias("storage"),
                 F.count(F.lit(1)).alias("files")))
    used = extents.groupBy("db_name", "tablespace_name").agg(F.sum("bytes").alias("used_bytes"))
    j = real.join(used, ["db_name", "tablespace_name"], "inner")
    free = F.col("real_bytes") - F.col("used_bytes")
    return (j.select(
        "db_name",
        F.col("tablespace_name").alias("tablespace"),
        F.round(F.col("real_bytes") / GB, 1).alias("realsize_gb"),
        F.round(F.col("used_bytes") / GB, 1).alias("used_gb"),
        F.round(free / GB, 1).alias("free_gb"),
        F.round(F.try_divide(free, F.col("real_bytes")) * 100, 1).alias("pct_free"),
        "storage", "files")
        .orderBy("db_name", F.col("pct_free").asc_nulls_last()))


def empty_tablespaces(data_files: DataFrame, segments: DataFrame, prefix_map=None) -> DataFrame:
    """Tablespaces that have files but hold no segment; files per storage class."""
    used = segments.select("db_name", "tablespace_name").distinct()
    return (data_files.join(used, ["db_name", "tablespace_name"], "left_anti")
            .groupBy("db_name", "tablespace_name",
                     _storage_class(F.col("file_name"), prefix_map).alias("storage"))
            .agg(F.count(F.lit(1)).alias("files"))
            .orderBy("db_name", "tablespace_name", "storage"))


def _every_database(totals: DataFrame, databases: DataFrame | None) -> DataFrame:
    """A row for every database, also for those with nothing to add up."""
    return totals if databases is None else databases.select("db_name").distinct().join(totals, "db_name", "left")


def datafile_total(data_files: DataFrame, databases: DataFrame | None = None) -> DataFrame:
    """Size of non-undo, non-system data files per database."""
    total = data_files.filter(_user_tablespace(F.col("tablespace_name"))).groupBy("db_name").agg(F.sum("bytes").alias("_b"))
    return (_every_database(total, databases)
            .select("db_name",
                    F.round(F.col("_b") / MB, 4).alias("datafile_size_mb"),
                    F.round(F.col("_b") / GB, 4).alias("datafile_size_gb")))


def recyclebin_total(recyclebin: DataFrame, databases: DataFrame | None = None) -> DataFrame:
    """Recoverable MB in the recycle bin (space is in 8 KiB blocks); NULL for
    a database whose bin is empty."""
    total = recyclebin.groupBy("db_name").agg((F.sum("space") / 128).alias("recoverable_mb"))
    return (_every_database(total, databases)
            .withColumn("remedy", F.lit("purge dba_recyclebin;")))


def autoextend_gaps(data_files: DataFrame, max_bytes: int = UNLIMITED_MAXBYTES) -> DataFrame:
    """Files that do not autoextend, or not up to the maximum size."""
    f = data_files.filter(((F.col("maxbytes") < max_bytes) | (F.col("autoextensible") == "NO"))
                          & _user_tablespace(F.col("tablespace_name")))
    return finding(
        f, "autoextend_gap", owner=F.lit(None), object_name="file_name",
        detail=nz_concat("autoextensible=", F.col("autoextensible"), " maxbytes=", F.col("maxbytes").cast("string")),
        remedy=nz_concat("alter database datafile ", quoted(F.col("file_name")), " autoextend on maxsize unlimited;"))


def small_increment(data_files: DataFrame, parameters: DataFrame, threshold: int = 1280) -> DataFrame:
    """Files whose next extent is below ``threshold`` blocks (S16); the
    proposed increment is 20M on blocks above 8 KiB, else 10M."""
    bs = block_size(parameters)
    f = (data_files.filter((F.col("increment_by") < threshold) & _user_tablespace(F.col("tablespace_name")))
         .join(per_database(bs), "db_name", "left"))
    next_ext = F.when(F.col("block_size") > 8192, "20M").otherwise("10M")
    return finding(
        f, "small_increment", owner=F.lit(None), object_name="file_name",
        detail=nz_concat("next_mb=", (F.col("increment_by") / 128).cast("string")),
        remedy=nz_concat("alter database datafile ", quoted(F.col("file_name")), " autoextend on next ", next_ext, ";"))


def high_water_mark(extents: DataFrame) -> DataFrame:
    """(db_name, file_id, hwm): highest block in use per file."""
    return (extents.groupBy("db_name", "file_id")
            .agg(F.max(F.col("block_id") + F.col("blocks") - 1).alias("hwm")))


def reclaimable_space(data_files: DataFrame, extents: DataFrame, parameters: DataFrame,
                      slack_mb: int = 9, min_mb: int = 10) -> DataFrame:
    """Files that can be resized down to their high-water mark + slack.

    shrunk = ceil(hwm * block_size / MB) + slack; kept when the file's
    blocks exceed the HWM by more than ``min_mb`` MB (real block size, S17).
    """
    hwm = high_water_mark(extents)          # partial aggregate before the join
    bs = block_size(parameters)
    f = (data_files.filter(_user_tablespace(F.col("tablespace_name")))
         .join(hwm, ["db_name", "file_id"], "left")
         .join(per_database(bs), "db_name", "left"))
    hwm_mb = F.ceil(F.coalesce(F.col("hwm"), F.lit(1)) * F.col("block_size") / MB)
    shrunk = hwm_mb + slack_mb
    keep = F.ceil(F.col("blocks") * F.col("block_size") / MB) - hwm_mb > min_mb
    return (f.filter(keep)
            .select("db_name", "file_id", "file_name",
                    (F.col("bytes") / MB).alias("real_size_mb"),
                    shrunk.cast("bigint").alias("shrunk_size_mb"),
                    (F.col("bytes") / MB - shrunk).alias("released_mb"),
                    nz_concat("alter database datafile ", quoted(F.col("file_name")), " resize ",
                              shrunk.cast("string"), " m;").alias("remedy")))


def user_files(data_files: DataFrame) -> DataFrame:
    """Data files outside undo and system tablespaces, as shrink plans measure them."""
    return data_files.filter(_user_tablespace(F.col("tablespace_name")))


def size_delta(before: DataFrame, after: DataFrame, keys=("db_name",), size_col: str = "bytes") -> DataFrame:
    """Total size before, after and recovered (MB) per key."""
    keys = list(keys)
    b = before.groupBy(*keys).agg(F.sum(size_col).alias("_before"))
    a = after.groupBy(*keys).agg(F.sum(size_col).alias("_after"))
    return (b.join(a, keys, "full_outer")
            .select(*keys,
                    F.round(F.coalesce("_before", F.lit(0)) / MB, 4).alias("before_mb"),
                    F.round(F.coalesce("_after", F.lit(0)) / MB, 4).alias("after_mb"),
                    F.round((F.coalesce("_before", F.lit(0)) - F.coalesce("_after", F.lit(0))) / MB, 4)
                    .alias("recovered_mb")))


def resized_files(data_files: DataFrame, plan: DataFrame) -> DataFrame:
    """Data files as they would be after applying a ``reclaimable_space`` plan."""
    p = plan.select("db_name", "file_id", (F.col("shrunk_size_mb") * MB).alias("_new"))
    return (data_files.join(p, ["db_name", "file_id"], "left")
            .withColumn("bytes", F.coalesce(F.col("_new"), F.col("bytes")).cast("bigint"))
            .drop("_new"))


# --------------------------------------------------------------- segments

def segment_footprint(segments: DataFrame, indexes: DataFrame, lobs: DataFrame,
                      owner: str | None = None, table: str | None = None) -> DataFrame:
    """Data, index and LOB MB and segment count per table, always three labelled
    rows: a kind without segments has NULL MB and count 0. Without owner/table
    it runs for every table of the fleet."""
    def _scope(df, o, t):
        if owner is not None:
            df = df.filter(F.col(o) == owner)
        if table is not None:
            df = df.filter(F.col(t) == table)
        return df

    seg = segments.select("db_name", "owner", "segment_name", "bytes")
    # A table's data segments carry its owner and name (table or table partition).
    data = (_scope(segments.filter(F.col("segment_type").like("TABLE%")), "owner", "segment_name")
            .select("db_name", F.col("owner").alias("table_owner"), F.col("segment_name").alias("table_name"), "bytes")
            .withColumn("kind", F.lit("Total Data Segments")))
    ix_keys = (_scope(indexes, "table_owner", "table_name")
               .select("db_name", F.col("owner").alias("owner"), F.col("index_name").alias("segment_name"),
                       "table_owner", "table_name").distinct())
    idx = (seg.join(ix_keys, ["db_name", "owner", "segment_name"], "inner")
           .select("db_name", "table_owner", "table_name", "bytes")
           .withColumn("kind", F.lit("Total Index Segments")))
    lob_keys = (_scope(lobs, "owner", "table_name")
                .select("db_name", "owner", "segment_name", F.col("owner").alias("table_owner"), "table_name")
                .distinct())
    lob = (seg.join(lob_keys, ["db_name", "owner", "segment_name"], "inner")
           .select("db_name", "table_owner", "table_name", "bytes")
           .withColumn("kind", F.lit("Total LOB Segments")))
    kinds = ("Total Data Segments", "Total Index Segments", "Total LOB Segments")
    sums = [f(F.when(F.col("kind") == k, F.col("bytes"))).alias(f"_{n}{i}")
            for i, k in enumerate(kinds) for n, f in (("b", F.sum), ("n", F.count))]
    t = data.unionByName(idx).unionByName(lob).groupBy("db_name", "table_owner", "table_name").agg(*sums)
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.round(F.col(f"_b{i}") / MB, 0).alias("mb"),
                                        F.col(f"_n{i}").alias("segments")) for i, k in enumerate(kinds)]))
    return t.select("db_name", "table_owner", "table_name", rows.alias("r")).select("db_name", "table_owner", "table_name", "r.*")


def top_lobs(lobs: DataFrame, segments: DataFrame, n: int = 10, owner_like: str = "%") -> DataFrame:
    """Largest ``n`` LOB columns per database by MB (segment joined on
    owner and name, S23). Ties break on owner, table, column."""
    seg = segments.filter(F.col("segment_type").like("LOB%")).select("db_name", "owner", "segment_name", "bytes")
    per_col = (lobs.filter(F.col("owner").like(owner_like))
               .join(seg, ["db_name", "owner", "segment_name"], "inner")
               .groupBy("db_name", "owner", "table_name", "column_name")
               .agg(F.sum("bytes").alias("_b")))
    w = Window.partitionBy("db_name").orderBy(F.col("_b").desc(), "owner", "table_name", "column_name")
    return (per_col.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= n)
            .select("db_name", nz_concat(F.col("owner"), ".", F.col("table_name")).alias("lob_table"),
                    "column_name", F.round(F.col("_b") / MB, 0).alias("mb"), "rank"))


def storage_totals(data_files: DataFrame, temp_files: DataFrame, segments: DataFrame,
                   redo: DataFrame) -> DataFrame:
    """GB held by data files, temp files, segments and online redo."""
    def _t(df, label, size):
        return df.groupBy("db_name").agg(F.round(F.sum(size) / GB, 3).alias("gb_used")) \
                 .withColumn("kind", F.lit(label))
    return (_t(data_files, "datafiles", F.col("bytes"))
            .unionByName(_t(temp_files, "tempfiles", F.col("bytes")))
            .unionByName(_t(segments, "segments", F.col("bytes")))
            .unionByName(_t(redo, "online redo logs", F.col("bytes") * F.col("members")))
            .select("db_name", "kind", "gb_used"))


def temp_usage(sort_usage: DataFrame) -> DataFrame:
    """Temp blocks in use per temp tablespace, descending."""
    return (sort_usage.groupBy("db_name", "tablespace")
            .agg(F.sum("blocks").alias("total_blocks"))
            .orderBy("db_name", F.col("total_blocks").desc()))


def misplaced_segments(segments: DataFrame, tablespaces: DataFrame, internal_owners: DataFrame) -> DataFrame:
    """Counts of (a) non-internal owners' segments in system tablespaces and
    (b) internal owners' segments in non-system permanent tablespaces."""
    io = internal_owners.select("owner").distinct()
    s = segments.select("db_name", "owner", "tablespace_name", "segment_type")
    a = (s.filter(F.col("tablespace_name").like("SYS%"))
         .join(F.broadcast(io), "owner", "left_anti")
         .withColumn("problem", F.lit("non-system object in system tablespace")))
    perm = tablespaces.filter(F.col("contents") == "PERMANENT").select("db_name", "tablespace_name").distinct()
    b = (s.filter(~F.col("tablespace_name").like("SYS%"))
         .join(perm, ["db_name", "tablespace_name"], "left_semi")
         .join(F.broadcast(io), "owner", "left_semi")
         .withColumn("problem", F.lit("system object in non-system tablespace")))
    return (a.unionByName(b)
            .groupBy("db_name", "problem", "owner", "tablespace_name", "segment_type")
            .agg(F.count(F.lit(1)).alias("cnt"))
            .orderBy("db_name", "problem", "owner", "tablespace_name", "segment_type"))


def _degree(c: Column) -> Column:
    return F.when(F.trim(c) == "DEFAULT", F.lit(1)).otherwise(F.trim(c).try_cast("int"))


def parallel_degree(tables: DataFrame, indexes: DataFrame) -> DataFrame:
    """Tables and indexes allowing parallel operations (degree > 1,
    DEFAULT counts as 1; numeric compare for both kinds, S24)."""
    t = (tables.filter((_degree(F.col("degree")) > 1) & ~F.col("owner").like("%SYS%"))
         .select("db_name", F.lit("TABLE").alias("object_type"), "owner", "table_name",
                 F.lit(None).cast("string").alias("index_name"), F.trim("degree").alias("degree")))
    i = (indexes.filter((_degree(F.col("degree")) > 1) & ~F.col("owner").like("%SYS%"))
         .select("db_name", F.lit("INDEX").alias("object_type"), "owner", "table_name",
                 "index_name", F.trim("degree").alias("degree")))
    return t.unionByName(i)


# ---------------------------------------------------- recovery area / redo

def recovery_area_pct(recovery_dest: DataFrame) -> DataFrame:
    """Actual and logical (minus reclaimable) percent used."""
    lim = F.col("space_limit")
    return recovery_dest.select(
        "db_name",
        F.round(F.try_divide(F.col("space_used"), lim) * 100, 0).alias("pct_used"),
        F.round(F.try_divide(F.col("space_used") - F.col("space_reclaimable"), lim) * 100, 0).alias("pct_logical"))


def redo_runway_hours(recovery_dest: DataFrame, archived_log: DataFrame, as_of: str,
                      hours: int = 6, reclaimable_counts_as_free: bool = False) -> DataFrame:
    """Hours until the recovery area is full at the trailing ``hours``
    average redo rate. The source subtracts reclaimable space from the free
    space (S15); ``reclaimable_counts_as_free=True`` adds it back instead.
    NULL runway when no redo was seen in the window (S8)."""
    since = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(hours)} HOURS")
    rate = (archived_log
            .filter((F.col("deleted") == "NO") & (F.col("is_recovery_dest_file") == "YES")
                    & (F.col("completion_time") > since))
            .groupBy("db_name")
            .agg((F.sum(F.col("blocks") * F.col("block_size")) / hours).alias("redo_bytes_per_hour")))
    free = F.col("space_limit") - F.col("space_used")
    free = free + F.col("space_reclaimable") if reclaimable_counts_as_free else free - F.col("space_reclaimable")
    return (recovery_dest.join(rate, "db_name", "left")
            .select("db_name", F.round(F.col("redo_bytes_per_hour"), 1).alias("redo_bytes_per_hour"),
                    F.round(F.try_divide(free, F.col("redo_bytes_per_hour")), 1).alias("runway_hours")))


def latest_readings(recovery_dest: DataFrame, archived_log: DataFrame, as_of: str, hours: int = 6) -> DataFrame:
    """One reading per database: the three monitored values at ``as_of``."""
    return (recovery_area_pct(recovery_dest)
            .join(redo_runway_hours(recovery_dest, archived_log, as_of, hours), "db_name", "left")
            .select("db_name", "pct_used", "pct_logical", "runway_hours",
                    F.lit(as_of).cast("timestamp_ntz").alias("reading_ts")))


def threshold_alerts(readings: DataFrame, pct: float = 60) -> DataFrame:
    """Databases whose logical use exceeds ``pct``, with all readings."""
    return (readings.filter(F.col("pct_logical") > pct)
            .select("db_name", "pct_used", "pct_logical", "runway_hours",
                    (F.col("runway_hours") / 24).alias("runway_days")))


# ------------------------------------------------------------ redo growth

def daily_counter(sysstat: DataFrame, as_of: str, trend_days: int = 7, stat: str = "redo size") -> DataFrame:
    """(db_name, day, counter_mb): per day the max cumulative counter of
    each instance, summed over instances, in whole MB."""
    since = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(trend_days)} DAYS")
    per_inst = (sysstat.filter((F.col("begin_interval_time") > since) & (F.col("stat_name") == stat))
                .groupBy("db_name", F.to_date("begin_interval_time").alias("day"), "instance_number")
                .agg(F.max("value").alias("credo")))
    return (per_inst.groupBy("db_name", "day")
            .agg(F.round(F.sum("credo") / MB, 0).alias("counter_mb")))


def daily_counter_growth(sysstat: DataFrame, as_of: str, trend_days: int = 7, num_days: int = 8,
                         stat: str = "redo size", factor: int = 1, drop_resets: bool = False) -> DataFrame:
    """Average day-over-day growth of a cumulative counter × ``num_days``
    (× ``factor``), in MB. A day pairs only with the *calendar* previous
    day, so a missing day drops a pair. Counter resets (negative deltas)
    count unless ``drop_resets`` (S26)."""
    by_day = Window.partitionBy("db_name").orderBy("day")           # one row per database and day
    delta = (daily_counter(sysstat, as_of, trend_days, stat)
             .withColumns({"_day": F.lag("day").over(by_day), "_mb": F.lag("counter_mb").over(by_day)})
             .filter(F.date_add("_day", 1) == F.col("day"))
             .select("db_name", (F.col("counter_mb") - F.col("_mb")).alias("delta")))
    if drop_resets:
        delta = delta.filter(F.col("delta") >= 0)
    return (delta.groupBy("db_name")
            .agg((F.round(F.avg("delta"), 0) * (num_days * factor)).cast("bigint").alias("estimate_mb")))


def required_free_space(sysstat: DataFrame, as_of: str, trend_days: int = 7, num_days: int = 8,
                        factor: int = 2, stat: str = "redo size") -> DataFrame:
    return daily_counter_growth(sysstat, as_of, trend_days, num_days, stat, factor) \
        .withColumnRenamed("estimate_mb", "required_mb")


def recovery_area_free(recovery_usage: DataFrame, parameters: DataFrame) -> DataFrame:
    """Free MB in the recovery area: (100 - round(Σ%used - Σ%reclaimable)) % of its size."""
    used = (recovery_usage.groupBy("db_name")
            .agg(F.round(F.sum("percent_space_used") - F.sum("percent_space_reclaimable"), 0).alias("used_pct")))
    size = (parameters.filter(F.col("name") == "db_recovery_file_dest_size")
            .select("db_name", F.col("value").try_cast("bigint").alias("dest_size")))
    return (used.join(size, "db_name", "inner")
            .select("db_name", "used_pct",
                    F.round((100 - F.col("used_pct")) * F.col("dest_size") / MB / 100, 0).cast("bigint").alias("free_mb")))


def sizing_verdict(growth: DataFrame, free: DataFrame, factor: int = 2) -> DataFrame:
    """Need (``factor`` times the estimated growth) vs free in one row per database."""
    return (growth.withColumn("required_mb", F.col("estimate_mb") * factor).join(free.select("db_name", "free_mb"), "db_name", "full_outer")
            .select("db_name", "estimate_mb", "required_mb", "free_mb",
                    (F.col("free_mb") >= F.col("required_mb")).alias("sufficient")))


# ------------------------------------------------------------------ memory

def memory_stats(pgastat: DataFrame, as_text: bool = False) -> DataFrame:
    """Statistics with byte values in MB and the unit relabelled; ``as_text``
    gives the value in the report's number format."""
    is_b = F.col("unit").eqNullSafe("bytes")
    value = F.when(is_b, F.col("value") / MB).otherwise(F.col("value"))
    return pgastat.select(
        "db_name", "name",
        (number_text(value, "999,999,999.9") if as_text else F.round(value, 1)).alias("value"),
        F.when(is_b, F.lit("mbytes")).otherwise(F.col("unit")).alias("unit"))


def memory_advice(pga_advice: DataFrame, as_text: bool = False) -> DataFrame:
    """Advice rows: MB truncated toward zero and factors as percent;
    ``as_text`` gives the percentages in the report's number format."""
    factor, hits = F.col("pga_target_factor") * 100, F.col("estd_pga_cache_hit_percentage")
    return pga_advice.select(
        "db_name",
        trunc_toward_zero(F.col("pga_target_for_estimate") / MB).cast("bigint").alias("target_mb"),
        (number_text(factor, "999.9%") if as_text else F.round(factor, 1)).alias("target_factor_pct"),
        trunc_toward_zero(F.col("bytes_processed") / MB).cast("bigint").alias("bytes_processed_mb"),
        trunc_toward_zero(F.col("estd_extra_bytes_rw") / MB).cast("bigint").alias("extra_bytes_rw_mb"),
        (number_text(hits, "999%") if as_text else F.round(hits, 0)).alias("cache_hit_pct"),
        F.col("estd_overalloc_count").alias("overalloc_count"))


def license_cpus(parameters: DataFrame) -> DataFrame:
    """Licensable CPU count: cpu_count / 4."""
    return (parameters.filter(F.col("name").like("cpu_count"))
            .select("db_name", (F.col("value").try_cast("double") / 4).alias("license_cpus")))
