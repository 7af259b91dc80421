"""Reading catalog snapshots of a fleet.

A snapshot of one catalog role for many databases is a Parquet table
partitioned by ``db_name``; reading a subset of databases prunes
partitions, and only the columns an operator selects are read.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estatelens.session import checkpoint_dir
from estatelens.sources.schemas import role_schema
from estatelens.functions.fleet import per_database

def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh folder below the shared checkpoint dir (never machine-local
    on a cluster: the dir comes from ``spark.checkpoint.dir``)."""
    return "/".join([checkpoint_dir(spark).rstrip("/"), "estatelens", *parts, uuid.uuid4().hex])


def write_catalog(df: DataFrame, path: str) -> None:
    """Store one role of many databases, partitioned by database."""
    # rebalance lets AQE split a database holding a large share of rows
    df.hint("rebalance", "db_name").write.mode("overwrite").partitionBy("db_name").parquet(path)


def scan_catalog(spark: SparkSession, path: str, role: str, databases=None) -> DataFrame:
    """Read one catalog role snapshot; reject it unless it has every column of
    the role's declared schema with the declared type; optionally keep only
    ``databases`` (a partition filter). Columns beyond the declared ones stay,
    a role that is not declared is read as it is."""
    df = spark.read.parquet(path)
    if "db_name" in df.columns and df.schema["db_name"].dataType != T.StringType():
        # partition values are inferred: "001" would become the number 1
        text = [T.StructField("db_name", T.StringType()) if f.name == "db_name" else f for f in df.schema.fields]
        df = spark.read.schema(T.StructType(text)).parquet(path)
    declared = role_schema(role)
    if declared is not None:
        found = {f.name: f.dataType for f in df.schema.fields}
        missing = [f.name for f in declared.fields if f.name not in found]
        if missing:
            raise ValueError(f"{role} snapshot at {path} lacks columns {missing}")
        wrong = [f"{f.name}: {found[f.name].simpleString()}, declared {f.dataType.simpleString()}" for f in declared.fields if found[f.name] != f.dataType]
        if wrong:
            raise ValueError(f"{role} snapshot at {path} has other types: {'; '.join(wrong)}")
    if databases is not None and "db_name" in df.columns:
        df = df.filter(F.col("db_name").isin(list(databases)))
    return df


def read_catalog_jdbc(spark: SparkSession, url: str, table: str, db_name: str, *,
                      partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
                      num_partitions: int | None = None, fetch_size: int = 10000,
                      properties: dict | None = None) -> DataFrame:
    """Read one catalog view of one live database over JDBC, split into
    ``num_partitions`` range reads on a numeric ``partition_column`` (for
    example ``object_id``), and key it by ``db_name``. Combine databases
    with ``fleet_union`` or append them to a ``write_catalog`` snapshot.
    Needs the database's JDBC driver on the classpath; not exercised by the
    tests (no database runs here)."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch_size)
    if partition_column is not None:
        if None in (lower, upper, num_partitions):
            raise ValueError("a partition column needs lower, upper and num_partitions")
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r.load().withColumn("db_name", F.lit(db_name))


def fleet_union(frames: dict) -> DataFrame:
    """Union a few per-database frames (e.g. one JDBC read per database) into
    one fleet frame keyed by ``db_name``; columns are matched by name. The plan
    has a branch per frame; many databases are written to folders and come back
    by ``fleet_read``."""
    parts = [df.withColumn("db_name", F.lit(db)) for db, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def fleet_read(spark: SparkSession, path: str, schema: T.StructType, databases=None) -> DataFrame:
    """The same query's rows of all databases, from one folder ``db_name=<name>`` each.

    One scan whatever the width of the fleet: the database is a partition
    column, so the plan does not grow and no list of databases is collected;
    ``databases`` prunes folders. A column that some database lacks reads NULL.
    """
    whole = T.StructType([*schema.fields, T.StructField("db_name", T.StringType())])
    df = spark.read.schema(whole).parquet(path)
    return df if databases is None else df.filter(F.col("db_name").isin(list(databases)))


def clone_flags(parameters: DataFrame) -> DataFrame:
    return (parameters.filter(F.col("name") == "clonedb")
            .select("db_name", (F.upper("value") == "TRUE").alias("is_clone")))


def database_status(containers: DataFrame, databases: DataFrame, parameters: DataFrame) -> DataFrame:
    """Per container: exists, open read-write, on a standby, on a clone.
    Plain booleans that are true on a match (S27)."""
    d = databases.select("db_name", "database_role")
    return (containers.join(d, "db_name", "left").join(clone_flags(parameters), "db_name", "left")
            .select("db_name", F.col("name").alias("container"), "con_id",
                    F.lit(True).alias("exists"),
                    (F.col("open_mode") == "READ WRITE").alias("is_open_rw"),
                    F.coalesce(F.col("database_role") != "PRIMARY", F.lit(False)).alias("is_standby"),
                    F.coalesce("is_clone", F.lit(False)).alias("is_clone")))


def fleet_select(df: DataFrame, databases: DataFrame, parameters: DataFrame, listed=None,
                 exclude_types=("standby", "clonedb"), container_col: str | None = None) -> DataFrame:
    """Rows of the listed databases (all when None) without those of the
    excluded types: ``standby`` (any role but PRIMARY) and ``clonedb``.
    With ``container_col`` rows of the root and seed containers go too."""
    unknown = set(exclude_types) - {"standby", "clonedb"}
    if unknown:
        raise ValueError(f"unknown database types {sorted(unknown)}")
    if container_col is not None:
        df = df.filter(~F.coalesce(F.col(container_col).isin("CDB$ROOT", "PDB$SEED"), F.lit(False)))
    keep = databases.select("db_name", "database_role").join(clone_flags(parameters), "db_name", "left")
    if listed is not None:
        keep = keep.filter(F.col("db_name").isin(list(listed)))
    if "standby" in exclude_types:
        keep = keep.filter(F.coalesce(F.col("database_role") == "PRIMARY", F.lit(True)))
    if "clonedb" in exclude_types:
        keep = keep.filter(~F.coalesce(F.col("is_clone"), F.lit(False)))
    return df.join(per_database(keep.select("db_name").distinct()), "db_name", "left_semi")


def parameter_value(parameters: DataFrame, name: str, cast: str = "string") -> DataFrame:
    """(db_name, value) of one named setting, typed at use (bad values NULL)."""
    v = F.col("value") if cast == "string" else F.col("value").try_cast(cast)
    return parameters.filter(F.col("name") == name).select("db_name", v.alias("value"))
