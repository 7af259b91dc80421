"""Structural health findings.

Each rule returns FINDING rows (rule_id, db_name, owner, object_name,
detail, remedy). Set membership tests are semi/anti joins on declared
NOT NULL keys that always include ``db_name`` (S3: a multi-column NOT IN
would plan a nested-loop join). Lookups of bounded, fixed size (type
exemption pairs) are broadcast; everything else is left to AQE.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelens.functions.deal import dealt
from estatelens.functions.findings import finding, not_internal
from estatelens.functions.sqlcompat import nz_concat, quoted

# parent/dependent object type pairs exempt from the
# dependency timestamp check (parent type, dependent type).
EXEMPT_TYPE_PAIRS = [(32, 1), (29, 5), (5, 2), (5, 55), (13, 2), (13, 55)]
# Parent status codes that count as healthy.
HEALTHY_PARENT_STATUS = [1, 2, 4]
# Replication related parameter name patterns.
REPLICATION_PARAMS = ("log_archive_%", "fal%", "db%name")


def _dot(a, b):
    return nz_concat(F.col(a), ".", F.col(b))


def restore_points(restore_points: DataFrame) -> DataFrame:
    ts = F.date_format("time", "yyyy-MM-dd HH:mm:ss")
    return finding(restore_points, "restore_point", object_name="name",
                   detail=nz_concat("Restore point active: ", F.col("name"), " at ", ts))


def acl_check(databases: DataFrame, network_acls: DataFrame) -> DataFrame:
    """'ACL OK' when exactly one wildcard ACL exists, else 'ACL Error'
    (a database with none is listed too)."""
    wild = (network_acls.filter(F.col("host") == "*").groupBy("db_name")
            .agg(F.count(F.lit(1)).alias("wildcard_acls")))
    return (databases.select("db_name").distinct().join(wild, "db_name", "left")
            .select("db_name", F.coalesce("wildcard_acls", F.lit(0)).alias("wildcard_acls"))
            .withColumn("status", F.when(F.col("wildcard_acls") == 1, "ACL OK").otherwise("ACL Error")))


def registry_problems(registry: DataFrame) -> DataFrame:
    return finding(registry.filter(F.col("status") != "VALID"), "registry_problem",
                   object_name="comp_id", detail=nz_concat(F.col("status"), " ", F.col("comp_name")))


def index_owner_mismatch(indexes: DataFrame) -> DataFrame:
    f = indexes.filter(F.col("owner") != F.col("table_owner"))
    return finding(f, "index_owner_mismatch", owner="owner", object_name="index_name",
                   detail=nz_concat("table ", _dot("table_owner", "table_name")))


def deprecated_type_columns(columns: DataFrame, internal_owners: DataFrame, data_type: str = "LONG") -> DataFrame:
    f = columns.filter((F.col("data_type") == data_type) & ~F.col("owner").like("APEX%"))
    f = not_internal(f, internal_owners)
    return finding(f, "deprecated_type", owner="owner", object_name="table_name",
                   detail=nz_concat(data_type, " column ", F.col("column_name")))


def unusable_indexes(indexes: DataFrame, ind_partitions: DataFrame, ignore=(), ordered: bool = False) -> DataFrame:
    """Rebuild remedies for unusable indexes and index partitions; unique
    ones first. Partitions take uniqueness from their index when known."""
    ix = indexes.filter(F.col("status") == "UNUSABLE")
    if ignore:
        ix = ix.filter(~F.col("index_name").isin(list(ignore)))
    a = ix.select("db_name", "owner", "index_name", F.lit(None).cast("string").alias("partition_name"),
                  "uniqueness",
                  nz_concat("alter index ", _dot("owner", "index_name"), " rebuild nologging online;").alias("remedy"))
    uq = indexes.select("db_name", F.col("owner").alias("index_owner"), "index_name", "uniqueness")
    b = (ind_partitions.filter(F.col("status") == "UNUSABLE")
         .join(uq, ["db_name", "index_owner", "index_name"], "left")
         .select("db_name", F.col("index_owner").alias("owner"), "index_name", "partition_name", "uniqueness",
                 nz_concat("alter index ", _dot("index_owner", "index_name"), " rebuild partition ",
                           F.col("partition_name"), " nologging online;").alias("remedy")))
    u = a.unionByName(b).distinct()
    if ordered:
        u = u.orderBy(F.col("uniqueness").desc_nulls_first())
    return finding(u, "unusable_index", owner="owner", object_name="index_name",
                   detail=nz_concat("uniqueness=", F.col("uniqueness")), remedy="remedy")


def nonunique_index_on_key(constraints: DataFrame, indexes: DataFrame) -> DataFrame:
    c = constraints.filter(F.col("constraint_type").isin("P", "U"))
    i = indexes.filter(F.col("uniqueness") == "NONUNIQUE").select(
        "db_name", F.col("owner").alias("index_owner"), "index_name")
    j = c.join(i, ["db_name", "index_owner", "index_name"], "inner")
    return finding(j, "nonunique_key_index", owner="owner", object_name="constraint_name",
                   detail=nz_concat(F.col("constraint_type"), " on ", _dot("owner", "table_name"),
                                    " index ", _dot("index_owner", "index_name")))


def chained_synonyms(synonyms: DataFrame) -> DataFrame:
    targets = synonyms.select("db_name", F.col("owner").alias("table_owner"),
                              F.col("synonym_name").alias("table_name")).distinct()
    f = synonyms.join(targets, ["db_name", "table_owner", "table_name"], "left_semi")
    return finding(f, "chained_synonym", owner="owner", object_name="synonym_name",
                   detail=nz_concat("points to synonym ", _dot("table_owner", "table_name")))


def invalid_synonyms(objects: DataFrame) -> DataFrame:
    f = objects.filter((F.col("status") == "INVALID") & (F.col("object_type") == "SYNONYM"))
    rem = F.when(F.col("owner") == "PUBLIC",
                 nz_concat("alter public synonym ", F.col("object_name"), " compile;")) \
        .otherwise(nz_concat("alter synonym ", _dot("owner", "object_name"), " compile;"))
    return finding(f, "invalid_synonym", owner="owner", object_name="object_name", remedy=rem).distinct()


def invalid_objects(objects: DataFrame, exclude_types=()) -> DataFrame:
    f = objects.filter(F.col("status") != "VALID")
    if exclude_types:
        f = f.filter(~F.col("object_type").isin(list(exclude_types)))
    return finding(f, "invalid_object", owner="owner", object_name="object_name",
                   detail=nz_concat(F.col("object_type"), " ", _dot("owner", "object_name")))


def invalid_object_count(objects: DataFrame, exclude_types=(), databases: DataFrame | None = None) -> DataFrame:
    """Invalid objects per database; 0 for every database of ``databases`` without any."""
    f = objects.filter(F.col("status") != "VALID")
    if exclude_types:
        f = f.filter(~F.col("object_type").isin(list(exclude_types)))
    n = f.groupBy("db_name").agg(F.count(F.lit(1)).alias("invalid_objects"))
    if databases is None:
        return n
    return databases.select("db_name").distinct().join(n, "db_name", "left").na.fill(0, ["invalid_objects"])


def _compile_remedy(obj_type, owner, name):
    return F.when(obj_type == "PACKAGE BODY",
                  nz_concat("alter package ", owner, ".", name, " compile body;")) \
        .otherwise(nz_concat("alter ", obj_type, " ", owner, ".", name, " compile;"))


def stale_dependents(objects: DataFrame, obj_dict: DataFrame, obj_dependency: DataFrame) -> DataFrame:
    """Editioned objects that are valid and depend on a valid parent whose
    timestamp differs from the one recorded with the dependency."""
    d = obj_dict.filter(F.col("status") == 1).select("db_name", F.col("obj_id").alias("d_obj"))
    p = obj_dict.filter(F.col("status") == 1).select("db_name", F.col("obj_id").alias("p_obj"), "stime")
    # parents first: a package that nearly everything depends on is a few (parent, timestamp) pairs, and only
    # edges to the pairs that moved meet the dependents
    seen = obj_dependency.select("db_name", "p_obj", "p_timestamp").distinct()
    moved = seen.join(dealt(p, "db_name", "p_obj"), ["db_name", "p_obj"], "inner").filter(F.col("stime") != F.col("p_timestamp")).select("db_name", "p_obj", "p_timestamp")
    pair = ["db_name", "p_obj", "p_timestamp"]
    stale = (obj_dependency.join(dealt(moved, *pair), pair, "left_semi")
             .select("db_name", "d_obj").distinct().join(dealt(d, "db_name", "d_obj"), ["db_name", "d_obj"], "left_semi")
             .select("db_name", F.col("d_obj").alias("object_id")))
    f = objects.filter(F.col("edition_name").isNotNull()).join(dealt(stale, "db_name", "object_id"), ["db_name", "object_id"], "left_semi")
    rem = nz_concat("alter session set edition=", F.col("edition_name"), ";\n",
                    _compile_remedy(F.col("object_type"), F.col("owner"), F.col("object_name")))
    return finding(f, "stale_dependent", owner="owner", object_name="object_name", remedy=rem)


def exempt_pairs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(EXEMPT_TYPE_PAIRS, "p_type int, d_type int")


def dependency_mismatch(objects: DataFrame, obj_dict: DataFrame, obj_dependency: DataFrame) -> DataFrame:
    """Objects to compile: dependents and parents of dependency edges with
    property bit 1 whose (valid, not a sub-object) dependent sees a parent that is not
    healthy or whose timestamp moved, unless the type pair is exempt."""
    spark = objects.sparkSession
    d = obj_dict.select("db_name", F.col("obj_id").alias("d_obj"), F.col("owner").alias("d_owner"),
                        F.col("name").alias("d_name"), F.col("type_id").alias("d_type"), F.col("status").alias("d_status"), "subname")
    p = obj_dict.select("db_name", F.col("obj_id").alias("p_obj"), F.col("owner").alias("p_owner"),
                        F.col("name").alias("p_name"), F.col("type_id").alias("p_type"),
                        F.col("status").alias("p_status"), F.col("stime").alias("p_stime"))
    edges = obj_dependency.filter(F.col("property").bitwiseAND(F.lit(1)) == 1)
    # a package that everybody depends on is one row here: parents meet the
    # dictionary once per recorded timestamp, and only those at fault go back to the edges
    bad = (edges.select("db_name", "p_obj", "p_timestamp").distinct().join(dealt(p, "db_name", "p_obj"), ["db_name", "p_obj"], "inner")
           .filter(~F.col("p_status").isin(HEALTHY_PARENT_STATUS) | (F.col("p_stime") != F.col("p_timestamp"))))
    e = (edges
         .join(dealt(d.filter((F.col("d_status") == 1) & F.col("subname").isNull()), "db_name", "d_obj"), ["db_name", "d_obj"], "inner")
         .join(dealt(bad, "db_name", "p_obj", "p_timestamp"), ["db_name", "p_obj", "p_timestamp"], "inner")
         # six fixed rows: broadcast is bounded by construction
         .join(F.broadcast(exempt_pairs(spark)), ["p_type", "d_type"], "left_anti"))
    # both ends of every edge from one pass over the joined edges
    ends = F.explode(F.array(F.struct(F.col("d_owner").alias("owner"), F.col("d_name").alias("object_name")),
                             F.struct(F.col("p_owner").alias("owner"), F.col("p_name").alias("object_name"))))
    names = e.select("db_name", ends.alias("o")).select("db_name", "o.owner", "o.object_name").distinct()
    f = objects.join(dealt(names, "db_name", "owner", "object_name"), ["db_name", "owner", "object_name"], "left_semi")
    out = finding(f, "dependency_mismatch", owner="owner", object_name="object_name",
                  remedy=nz_concat("alter ", F.col("object_type"), " ", _dot("owner", "object_name"), " compile;"))
    return out.distinct()


def broken_triggers(triggers: DataFrame, objects: DataFrame) -> DataFrame:
    bad = (objects.filter((F.col("object_type") == "TRIGGER") & (F.col("status") != "VALID"))
           .select("db_name", "owner", F.col("object_name").alias("trigger_name")))
    f = triggers.filter(F.col("status") == "ENABLED").join(dealt(bad, "db_name", "owner", "trigger_name"), ["db_name", "owner", "trigger_name"], "inner")
    return finding(f, "broken_trigger", owner="owner", object_name="trigger_name",
                   detail=nz_concat("Broken trigger: ", _dot("owner", "trigger_name")))


def trigger_owner_mismatch(triggers: DataFrame) -> DataFrame:
    f = triggers.filter((F.col("owner") != F.col("table_owner")) & ~F.col("trigger_type").like("%EVENT"))
    return finding(f, "trigger_owner_mismatch", owner="owner", object_name="trigger_name",
                   detail=nz_concat("table ", _dot("table_owner", "table_name")))


def disabled_triggers(triggers: DataFrame, internal_owners: DataFrame) -> DataFrame:
    f = triggers.filter((F.col("status") != "ENABLED") & ~F.col("owner").like("APEX%"))
    f = not_internal(f, internal_owners)
    return finding(f, "disabled_trigger", owner="owner", object_name="trigger_name",
                   detail=F.col("status"))


def leftover_jobs(datapump_jobs: DataFrame, objects: DataFrame) -> DataFrame:
    """Import/export jobs that are not running; drop remedy for the
    job's master table when it still exists."""
    masters = (objects.select("db_name", F.col("owner").alias("owner_name"), F.col("object_name").alias("job_name"))
               .distinct().withColumn("_has_master", F.lit(True)))
    j = (datapump_jobs.filter(F.col("state") == "NOT RUNNING")
         .join(dealt(masters, "db_name", "owner_name", "job_name"), ["db_name", "owner_name", "job_name"], "left"))
    rem = F.when(F.col("_has_master"), nz_concat("drop table ", _dot("owner_name", "job_name"), ";"))
    det = nz_concat(F.rtrim("operation"), " ", F.rtrim("job_mode"), " ", F.col("state"),
                    " sessions=", F.col("attached_sessions").cast("string"))
    return finding(j, "leftover_datapump_job", owner="owner_name", object_name="job_name", detail=det, remedy=rem)


def _stats_gate(df, owner_col, tab_stats, externals, part: bool):
    keys = ["db_name", owner_col, "table_name"] + (["partition_name"] if part else [])
    st = tab_stats.filter(F.col("stattype_locked").isNull())
    st = st.filter(F.col("partition_name").isNotNull()) if part else st
    st = st.select("db_name", F.col("owner").alias(owner_col), "table_name",
                   *(["partition_name"] if part else [])).distinct()
    ext = externals.select("db_name", F.col("owner").alias(owner_col), F.col("name").alias("table_name")).distinct()
    return (df.join(st, keys, "left_semi")                      # S18: one row per table
              .join(ext, ["db_name", owner_col, "table_name"], "left_anti"))


def _extra(df, owners, max_rows, predicate, owner_col):
    if owners is not None:
        df = df.join(owners.select("db_name", F.col("username").alias(owner_col)).distinct(),
                     ["db_name", owner_col], "left_semi")
    if max_rows is not None:
        df = df.filter(F.col("num_rows") < max_rows)
    if predicate:
        df = df.filter(F.expr(predicate))
    return df


def stale_table_stats(tables: DataFrame, tab_stats: DataFrame, externals: DataFrame, as_of: str,
                      age_days: int = 30, owners: DataFrame | None = None, max_rows: int | None = None,
                      predicate: str | None = None, ordered: bool = False, cascade: bool = False) -> DataFrame:
    """Tables never analysed or analysed more than ``age_days`` before
    ``as_of``; not temporary/secondary/external/locked. Without ``owners``
    (users of a profile) every non-system owner is checked. Smallest first."""
    cutoff = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(age_days)} DAYS")
    t = tables.filter((F.col("temporary") == "N") & (F.col("secondary") == "N")
                      & (F.col("segment_created") == "YES") & ~F.col("table_name").like("SYS%")
                      & (F.col("last_analyzed").isNull() | (F.col("last_analyzed") < cutoff)))
    if owners is None:
        t = t.filter(~F.col("owner").like("%SYS%") & (F.col("owner") != "XDB"))
    t = _extra(t, owners, max_rows, predicate, "owner")
    t = _stats_gate(t, "owner", tab_stats, externals, part=False)
    if ordered:
        t = t.orderBy(F.col("num_rows").asc_nulls_last())
    return finding(t, "stale_table_stats", owner="owner", object_name="table_name",
                   detail=nz_concat("num_rows=", F.col("num_rows").cast("string")),
                   remedy=_gather_remedy(cascade))


def _gather_remedy(cascade: bool):
    """Health-check form, or (``cascade``) the stats-gathering plan's form
    with a quoted table name and dependent indexes included."""
    if cascade:
        return nz_concat("exec DBMS_STATS.GATHER_TABLE_STATS(", quoted(F.col("owner")), ",'\"",
                         F.col("table_name"), "\"',CASCADE=>TRUE);")
    return nz_concat("exec DBMS_STATS.GATHER_TABLE_STATS(", quoted(F.col("owner")), ",",
                     quoted(F.col("table_name")), ");")


def unanalyzed_partitions(tab_partitions: DataFrame, tab_stats: DataFrame, externals: DataFrame,
                          owners: DataFrame | None = None, as_of: str | None = None, age_days: int | None = None,
                          max_rows: int | None = None, predicate: str | None = None,
                          ordered: bool = False) -> DataFrame:
    """Partitions never analysed (optionally: or older than ``age_days``, S19)."""
    never = F.col("last_analyzed").isNull()
    if age_days is not None and as_of is not None:
        cutoff = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(age_days)} DAYS")
        never = never | (F.col("last_analyzed") < cutoff)
    t = tab_partitions.filter((F.col("segment_created") == "YES") & never & ~F.col("table_name").like("SYS%"))
    t = _extra(t, owners, max_rows, predicate, "table_owner")
    t = _stats_gate(t, "table_owner", tab_stats, externals, part=True)
    if ordered:
        t = t.orderBy(F.col("num_rows").asc_nulls_last())
    rem = nz_concat("exec DBMS_STATS.GATHER_TABLE_STATS(", quoted(F.col("table_owner")), ",'\"",
                    F.col("table_name"), "\"',", quoted(F.col("partition_name")),
                    ",granularity=>'APPROX_GLOBAL AND PARTITION',CASCADE=>TRUE);")
    return finding(t, "unanalyzed_partition", owner="table_owner", object_name="partition_name",
                   detail=F.col("table_name"), remedy=rem)


def config_parameters(parameters: DataFrame, patterns=REPLICATION_PARAMS) -> DataFrame:
    """Replication settings: names matching ``patterns`` (dest-state
    names only when their value is not ENABLE)."""
    n = F.col("name")
    state = n.like("log_archive_dest_state%")
    match = reduce(lambda a, b: a | b, [n.like(p) for p in patterns])
    keep = F.col("value").isNotNull() & ((match & ~state) | (state & (F.upper("value") != "ENABLE")))
    return parameters.filter(keep).select("db_name", "name", "value")


def maintenance_gate(databases: DataFrame, restore_points: DataFrame, parameters: DataFrame) -> DataFrame:
    """May maintenance (shrink) run? Not when flashback is on, or on
    'RESTORE POINT ONLY' with at least one restore point, or on a clone."""
    rp = restore_points.groupBy("db_name").agg(F.count(F.lit(1)).alias("restore_points"))
    clone = (parameters.filter(F.col("name") == "clonedb")
             .select("db_name", (F.upper(F.col("value")) == "TRUE").alias("is_clone")))
    j = (databases.select("db_name", "flashback_on").join(rp, "db_name", "left").join(clone, "db_name", "left")
         .withColumn("restore_points", F.coalesce("restore_points", F.lit(0)))
         .withColumn("is_clone", F.coalesce("is_clone", F.lit(False))))
    fb = ~((F.col("flashback_on") == "NO")
           | ((F.col("flashback_on") == "RESTORE POINT ONLY") & (F.col("restore_points") == 0)))
    return j.select("db_name", "flashback_on", "restore_points", "is_clone",
                    (~fb & ~F.col("is_clone")).alias("may_run"),
                    F.when(fb, "flashback active").when(F.col("is_clone"), "clone database").alias("reason"))
