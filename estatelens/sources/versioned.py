"""A partitioned table whose changes rewrite only the partitions they touch.

Below ``path``: ``data/<commit>/part=<value>/`` holds files that are never
changed, ``versions/<n>/`` holds one row per partition of version n with the
commit that wrote it. A change writes the new partitions first and its version
last, as one file that Spark's commit protocol renames into place. Until then
readers see the old version, so a run that dies leaves it as it was, and files
of untouched partitions keep their names. The version also lists all commits,
so a change that is applied again under its name has no further effect. Two
writers that build on the same version cannot both commit: the second finds the
next version's folder taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

PART = "part"
VERSION = f"version bigint, {PART} string, commit string, commits array<string>, schema string"


def _versions(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(VERSION).parquet(f"{path}/versions/*")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def current(spark: SparkSession, path: str) -> list:
    """Rows of the latest version: one per partition, plus one without partition. A table's metadata, as long as its list of partitions."""
    v = _versions(spark, path)
    if v is None:
        return []
    last = v.agg(F.max("version")).first()[0]
    return v.filter(F.col("version") == last).collect()


def _write(df: DataFrame, path: str, commit: str) -> set[str]:
    """Write rows with their ``part`` below the commit's folder; the partitions that have rows."""
    target = f"{path}/data/{commit}"
    df.hint("rebalance", PART).write.mode("overwrite").partitionBy(PART).parquet(target)
    return {r[0] for r in df.sparkSession.read.schema(df.schema).parquet(target).select(PART).distinct().collect()}


def _publish(spark: SparkSession, path: str, version: int, parts: dict[str, str], commits: list[str], schema: str) -> None:
    rows = [(version, p, c, None, None) for p, c in sorted(parts.items())] + [(version, None, None, commits, schema)]
    spark.createDataFrame(rows, VERSION).coalesce(1).write.mode("errorifexists").parquet(f"{path}/versions/{version}")


def create(df: DataFrame, path: str, part: Column, commit: str = "initial") -> None:
    """Start the table with the rows of ``df``, partitioned by the text of ``part``."""
    spark = df.sparkSession
    if current(spark, path):
        return
    rows = df.withColumn(PART, F.coalesce(part.cast("string"), F.lit("none")))
    _publish(spark, path, 1, dict.fromkeys(_write(rows, path, commit), commit), [commit], rows.schema.json())


def _read(spark: SparkSession, path: str, rows: list, parts=None) -> DataFrame:
    from pyspark.sql import types as T
    import json

    head = next(r for r in rows if r.commits is not None)
    schema = T.StructType.fromJson(json.loads(head.schema))
    plain = T.StructType([f for f in schema.fields if f.name != PART])
    wanted = [(r.part, r.commit) for r in rows if r.part is not None and (parts is None or r.part in parts)]
    out = None
    for commit in sorted({c for _, c in wanted}):         # one scan for each commit that still holds partitions
        paths = [f"{path}/data/{commit}/{PART}={p}" for p, c in wanted if c == commit]
        one = spark.read.schema(schema).option("basePath", f"{path}/data/{commit}").parquet(*paths)
        out = one if out is None else out.unionByName(one)
    return out if out is not None else spark.createDataFrame([], T.StructType([*plain.fields, schema[PART]]))


def read(spark: SparkSession, path: str, parts=None) -> DataFrame:
    """The latest version, or only some of its partitions."""
    rows = current(spark, path)
    if not rows:
        raise ValueError(f"no table at {path}")
    return _read(spark, path, rows, parts)


def apply(path: str, delta: DataFrame, keys, part: Column, commit: str) -> bool:
    """Apply a delta (op, keys, other columns) as one new version; False if ``commit`` was applied before.

    Only partitions that hold a key of the delta, or get a row from it, are
    rewritten: their other rows and the delta's inserted and updated ones.
    """
    spark = delta.sparkSession
    keys = list(keys)
    rows = current(spark, path)
    head = next(r for r in rows if r.commits is not None)
    if commit in head.commits:
        return False
    table = _read(spark, path, rows)
    upserts = delta.filter("op <> 'delete'").drop("op").withColumn(PART, F.coalesce(part.cast("string"), F.lit("none"))).select(*table.columns)
    hit = table.select(*keys, PART).join(delta.select(*keys), keys, "left_semi").select(PART)         # keys and partition only
    touched = {r[0] for r in hit.unionByName(upserts.select(PART)).distinct().collect()}
    kept = _read(spark, path, rows, touched).join(delta.select(*keys), keys, "left_anti")
    written = _write(kept.unionByName(upserts), path, commit) if touched else set()
    parts = {r.part: r.commit for r in rows if r.part is not None and r.part not in touched}
    _publish(spark, path, head.version + 1, parts | dict.fromkeys(written, commit), [*head.commits, commit], head.schema)
    return True
