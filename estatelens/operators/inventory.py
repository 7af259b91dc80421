"""Inventories, state capture and snapshot diff.

Inventories are distinct ``(db_name, line)`` sets, one per kind, meant for
``sources.sinks.write_inventory`` (which sorts within the written
partitions instead of a global sort). Line formats follow the source's
comma-joined text so snapshots diff line by line.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelens.functions.findings import not_internal
from estatelens.functions.sqlcompat import nz_concat
from estatelens.functions.fleet import per_database

# Owners left out of the sequence section of a state capture.
STATE_SEQ_EXCLUDE = ("SYS", "SYSTEM", "DBSNMP")
# Fixed value: schema left out of the schema list.
SCHEMA_EXCLUDE = ("MIGRATION",)
ROOT_CONTAINERS = ("CDB$ROOT", "PDB$SEED")
TS_FMT = "yyyy-MM-dd HH:mm:ss"


def _s(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string")


def _line(*parts, sep=",") -> Column:
    """Join parts with ``sep``; NULL parts become empty text (S1)."""
    out = []
    for i, p in enumerate(parts):
        if i:
            out.append(F.lit(sep))
        out.append(_s(p))
    return F.concat_ws("", *out)


def _lines(df: DataFrame, line: Column) -> DataFrame:
    return df.select("db_name", line.alias("line"))


def _union(*dfs):
    return reduce(DataFrame.unionByName, dfs)


def inv_database(instance: DataFrame, parameters: DataFrame, databases: DataFrame,
                 registry_history: DataFrame) -> DataFrame:
    v = _lines(instance, nz_concat("version: ", F.col("version")))
    sp = _lines(parameters.filter(F.col("name") == "spfile"), nz_concat("spfile location: ", F.col("value")))
    d = _lines(databases, nz_concat("database: ", _line("dbid", "name", "db_unique_name", F.date_format("created", TS_FMT), "log_mode", "open_mode",
                                                           "database_role", "primary_db_unique_name")))
    h = _lines(registry_history, nz_concat("patch: ", _line(F.date_format("action_time", TS_FMT), "action", "namespace", "version", "id",
                                                               "bundle_series", "comments")))
    return _union(v, sp, d, h).distinct()


def inv_profiles_directories(sql_profiles: DataFrame, directories: DataFrame) -> DataFrame:
    p = (sql_profiles.groupBy("db_name").agg(F.count(F.lit(1)).alias("n"))
         .select("db_name", nz_concat("SQL Profiles: ", F.col("n").cast("string")).alias("line")))
    d = _lines(directories, nz_concat("Directory: ", F.col("owner"), ".", F.col("directory_name"), " ",
                                      F.col("directory_path")))
    return _union(p, d).distinct()


def inv_containers(containers: DataFrame, instance: DataFrame) -> DataFrame:
    c = containers.join(per_database(instance.select("db_name", "host_name"), several="smallest"), "db_name", "left")
    a = _lines(c, _line("name", "con_id", "host_name", "db_name", "open_mode", sep=" "))
    b = _lines(containers.filter(~F.col("name").isin(list(ROOT_CONTAINERS))), nz_concat("PDB: ", F.col("name")))
    return _union(a, b).distinct()


def inv_saved_states(saved_states: DataFrame, databases: DataFrame, db_properties: DataFrame) -> DataFrame:
    a = _lines(saved_states, nz_concat("SavedState: ", _line("con_name", "state", sep=" ")))
    b = _lines(databases, nz_concat("LogMode: ", _line("name", "log_mode", sep=" ")))
    c = _lines(db_properties.filter(F.col("property_name") == "LOCAL_UNDO_ENABLED"),
               nz_concat("LocalUndo: ", F.col("property_value")))
    return _union(a, b, c).distinct()


def inv_users(users: DataFrame) -> DataFrame:
    return users.select("db_name", "username", "account_status", "lock_date", "expiry_date", "default_tablespace",
                        "temporary_tablespace", "created", "profile", "initial_rsrc_consumer_group", "password_versions",
                        "editions_enabled", "authentication_type")


def inv_segments(segments: DataFrame, internal_owners: DataFrame) -> DataFrame:
    s = segments.filter(~F.col("segment_name").like("BIN%") & ~F.col("segment_name").like("SYS%")
                        & ~F.col("owner").like("%SYS%") & ~F.col("owner").like("APEX%"))
    s = not_internal(s, internal_owners)
    return _lines(s, nz_concat(F.col("owner"), ".", _line("segment_name", "segment_type", "tablespace_name"))).distinct()


def inv_objects(objects: DataFrame, internal_owners: DataFrame) -> DataFrame:
    o = objects.filter(~F.col("object_name").like("BIN%") & ~F.col("owner").like("%SYS%"))
    o = not_internal(o, internal_owners)
    return _lines(o, nz_concat(F.col("owner"), ".", _line("object_name", "object_type", "status"))).distinct()


def inv_columns(constraints: DataFrame, cons_columns: DataFrame, columns: DataFrame, views: DataFrame,
                internal_owners: DataFrame) -> DataFrame:
    """Key columns of primary/unique keys, and columns of tables (not views)."""
    c = constraints.filter(~F.col("owner").like("%SYS%") & F.col("constraint_type").isin("P", "U"))
    c = not_internal(c, internal_owners)
    cc = cons_columns.select("db_name", "owner", "constraint_name", "column_name", "position")
    k = c.join(cc, ["db_name", "owner", "constraint_name"], "inner")
    a = _lines(k, nz_concat("Cons,", F.col("owner"), ".", _line("table_name", "constraint_type", "column_name",
                                                                   "position", "status", "constraint_name")))
    v = views.select("db_name", "owner", F.col("view_name").alias("table_name")).distinct()
    t = not_internal(columns.filter(~F.col("owner").like("%SYS%")), internal_owners) \
        .join(v, ["db_name", "owner", "table_name"], "left_anti")
    b = _lines(t, nz_concat("column,", F.col("owner"), ".", _line("table_name", "column_name", "data_type",
                                                                     "data_length", "nullable")))
    return _union(a, b).distinct()


def inv_schemas(tables: DataFrame, internal_owners: DataFrame) -> DataFrame:
    t = not_internal(tables.filter(~F.col("owner").isin(list(SCHEMA_EXCLUDE))), internal_owners)
    return _lines(t, F.col("owner")).distinct()


def inv_jobs(scheduler_jobs: DataFrame, jobs: DataFrame) -> DataFrame:
    a = _lines(scheduler_jobs, nz_concat("Scheduler: ", _line("owner", "job_name", "enabled", "state")))
    b = _lines(jobs, nz_concat("Job: ", _line("schema_user", "job", "broken", "what")))
    return _union(a, b).distinct()


def inv_storage(tablespaces: DataFrame, ts_groups: DataFrame, data_files: DataFrame, temp_files: DataFrame,
                redo: DataFrame, standby_redo: DataFrame) -> DataFrame:
    gb = lambda c: (F.col(c) / 1073741824).cast("string")
    parts = [
        _lines(tablespaces, nz_concat(F.col("contents"), " Tablespace ", _line("tablespace_name", "block_size", "initial_extent", "extent_management", "allocation_type",
                                                                                      "segment_space_management", "bigfile"))),
        _lines(ts_groups, nz_concat("Tempspace Group: ", _line("group_name", "tablespace_name", sep=" "))),
        _lines(data_files, nz_concat("Datafile: ", F.col("tablespace_name"), " ",
                                     _line("file_name", "bytes", "maxbytes", "autoextensible", "increment_by"))),
        _lines(temp_files, nz_concat("Tempfile: ", F.col("tablespace_name"), " ",
                                     _line("file_name", "bytes", "maxbytes", "autoextensible", "increment_by"))),
        _lines(redo, nz_concat("Online Redo - thread: ", _s("thread"), "  group: ", _s("group_no"), " size: ",
                               gb("bytes"), " GB  members: ", _s("members"))),
        _lines(standby_redo, nz_concat("Standby Redo - thread: ", _s("thread"), "  group: ", _s("group_no"),
                                       " size: ", gb("bytes"), " GB")),
    ]
    return _union(*parts).distinct()


def _owned_lines(df: DataFrame, internal_owners: DataFrame, owner_col: str, *cols) -> DataFrame:
    f = not_internal(df.filter(~F.col(owner_col).like("APEX%")), internal_owners, owner_col=owner_col)
    return _lines(f, _line(owner_col, *cols)).distinct()


def inv_tables(tables, internal_owners):
    return _owned_lines(tables, internal_owners, "owner", "table_name", "temporary")


def inv_indexes(indexes, internal_owners):
    return _owned_lines(indexes, internal_owners, "owner", "table_name", "index_name", "index_type", "uniqueness",
                        "compression")


def inv_views(views, internal_owners):
    return _owned_lines(views, internal_owners, "owner", "view_name")


def inv_sequences(sequences, internal_owners):
    return _owned_lines(sequences, internal_owners, "sequence_owner", "sequence_name", "increment_by", "cycle_flag",
                        "order_flag")


def inv_triggers(triggers, internal_owners):
    return _owned_lines(triggers, internal_owners, "owner", "trigger_name", "trigger_type", "table_name", "status")


def state_capture(objects: DataFrame, errors: DataFrame, sequences: DataFrame, sessions: DataFrame) -> DataFrame:
    """Before-change state: object count, invalid objects, errors,
    sequence positions and user sessions, as (db_name, section, line)."""
    cnt = (objects.groupBy("db_name").agg(F.count(F.lit(1)).alias("n"))
           .select("db_name", F.lit("Object counts").alias("section"), F.col("n").cast("string").alias("line")))
    inv = objects.filter(F.col("status") != "VALID").select(
        "db_name", F.lit("Invalid objects").alias("section"), _line("object_name", "owner", "object_type").alias("line"))
    err = errors.select("db_name", F.lit("Errors").alias("section"), _line("owner", "name", "text").alias("line"))
    seq = sequences.filter(~F.col("sequence_owner").isin(list(STATE_SEQ_EXCLUDE))).select(
        "db_name", F.lit("Sequences").alias("section"),
        _line("sequence_owner", "sequence_name", "last_number").alias("line"))
    # fixed value: the module column is the first 30 characters of module:program
    module = F.substring(nz_concat(F.col("module"), ":", F.col("program")), 1, 30)
    ses = sessions.filter(F.col("type") == "USER").select("db_name", F.lit("Connections").alias("section"),
                                                          _line("username", module, "machine").alias("line"))
    return _union(cnt, inv, err, seq, ses)


def snapshot_diff(before: DataFrame, after: DataFrame, keys, attrs=None) -> DataFrame:
    """Lines added, removed or changed between two snapshots, by key;
    attributes compare NULL-safely. Columns: keys, change, then
    ``before_<a>`` / ``after_<a>`` for each attribute."""
    keys = list(keys)
    attrs = list(attrs) if attrs is not None else [c for c in after.columns if c not in keys]
    b = before.select(*keys, *[F.col(a).alias(f"before_{a}") for a in attrs], F.lit(True).alias("__b"))
    a = after.select(*keys, *[F.col(x).alias(f"after_{x}") for x in attrs], F.lit(True).alias("__a"))
    j = b.join(a, keys, "full_outer")
    same = reduce(lambda x, y: x & y, [F.col(f"before_{c}").eqNullSafe(F.col(f"after_{c}")) for c in attrs], F.lit(True))
    change = F.when(F.col("__b").isNull(), "added").when(F.col("__a").isNull(), "removed").when(~same, "changed")
    cols = [x for c in attrs for x in (f"before_{c}", f"after_{c}")]
    return j.withColumn("change", change).filter(F.col("change").isNotNull()).select(*keys, "change", *cols)
