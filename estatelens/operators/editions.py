"""Edition hierarchy: levels, deploy order, object counts (the source's CONNECT BY).

Each edition names its parent. Levels come from pointer doubling: every edition
keeps a pointer to an ancestor and its distance, and a round replaces the
pointer by the pointer's pointer, so a chain of n editions takes log2(n) joins.
A round that reaches no further root ends the loop: while a longer chain is
left, some edition on it lies within the doubled reach. What is left then hangs
on a cycle. The rounds are written to the shared folder, as each reads the last.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estatelens.functions.sqlcompat import nz_concat
from estatelens.session import checkpoint_dir

ROOT = "ORA$BASE"


def _staged(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def edition_levels(editions: DataFrame, root: str = ROOT) -> DataFrame:
    """(db_name, edition_name, parent_edition_name, level, state) of every edition.

    state: ``deployed`` when the chain of parents ends at ``root`` (level 1),
    ``detached`` when it ends at another edition without parent or at a parent
    that does not exist, ``cycle`` when it does not end. Level is NULL for the
    last two. Of several parents of one edition the smallest counts.
    """
    spark = editions.sparkSession
    base = f"{checkpoint_dir(spark).rstrip('/')}/estatelens/editions/{uuid.uuid4().hex}"
    e = editions.groupBy("db_name", "edition_name").agg(F.min("parent_edition_name").alias("parent_edition_name"))
    # a parent that is not there ends the chain like none
    known = e.select("db_name", F.col("edition_name").alias("parent_edition_name"), F.lit(True).alias("known"))
    step = e.join(known, ["db_name", "parent_edition_name"], "left").select(
        "db_name", "edition_name", "parent_edition_name", F.when(F.col("known"), F.col("parent_edition_name")).alias("up"),
        F.when(F.col("known"), 1).otherwise(0).cast("long").alias("distance"), F.lit(None).cast("string").alias("top"))
    step = _staged(step.withColumn("top", F.when(F.col("up").isNull(), F.col("edition_name"))), f"{base}/0")
    ended, k = -1, 0
    while True:
        now = step.filter("top is not null").count()
        if now == ended:
            break
        ended, k = now, k + 1
        upper = step.select("db_name", F.col("edition_name").alias("up"), F.col("up").alias("next"), F.col("distance").alias("more"), F.col("top").alias("end"))
        open_ = step.filter("top is null").drop("top").join(upper, ["db_name", "up"], "left")
        moved = open_.select("db_name", "edition_name", "parent_edition_name", F.col("next").alias("up"), (F.col("distance") + F.col("more")).alias("distance"), F.col("end").alias("top"))
        step = _staged(step.filter("top is not null").unionByName(moved), f"{base}/{k}")
    state = F.when(F.col("top") == root, "deployed").when(F.col("top").isNotNull(), "detached").otherwise("cycle")
    return step.select("db_name", "edition_name", "parent_edition_name", F.when(F.col("top") == root, F.col("distance") + 1).alias("level"), state.alias("state"))


def edition_order(editions: DataFrame, edition_privs: DataFrame, root: str = ROOT) -> DataFrame:
    """Levels with deploy order (parents first, then by name) and whether the edition may be used by anybody."""
    levels = edition_levels(editions, root)
    usable = (edition_privs.filter(F.col("privilege") == "USE").select("db_name", F.col("table_name").alias("edition_name"), F.lit(True).alias("usable")).distinct())
    order = F.row_number().over(Window.partitionBy("db_name", "state").orderBy("level", "edition_name"))
    return (levels.join(usable, ["db_name", "edition_name"], "left")
            .select("db_name", "edition_name", "parent_edition_name", "level", F.when(F.col("state") == "deployed", order).cast("long").alias("deploy_order"),
                    F.coalesce("usable", F.lit(False)).alias("usable"), "state"))


def edition_object_counts(edition_objects: DataFrame, comments: DataFrame, editions: DataFrame, root: str = ROOT, exclude_types=("SYNONYM",)) -> DataFrame:
    """Objects and last deployment by edition and status, for commented editions below ``root``; objects are counted before any join."""
    counts = (edition_objects.filter(~F.col("object_type").isin(*exclude_types)).groupBy("db_name", "edition_name", "status")
              .agg(F.max("created").alias("last_deploy"), F.count(F.lit(1)).alias("objects")))
    levels = edition_levels(editions, root).filter(F.col("state") == "deployed").select("db_name", "edition_name", F.col("level").alias("deploy_order"))
    return (counts.join(levels, ["db_name", "edition_name"]).join(comments.select("db_name", "edition_name", "comments"), ["db_name", "edition_name"])
            .select("db_name", "edition_name", "comments", "status", "last_deploy", "objects", "deploy_order"))


def default_edition(editions: DataFrame, db_properties: DataFrame) -> DataFrame:
    """(db_name, edition_name): the edition that the database's default property names, where it exists."""
    named = db_properties.filter(F.col("property_name") == "DEFAULT_EDITION").select("db_name", F.col("property_value").alias("edition_name")).distinct()
    return named.join(editions.select("db_name", "edition_name").distinct(), ["db_name", "edition_name"], "left_semi")


def service_editions(services: DataFrame) -> DataFrame:
    """(db_name, line): which edition each user service opens in."""
    line = nz_concat("Service ", F.col("name"), " Edition ", F.coalesce("edition", F.lit("(default)")))
    return services.filter(~F.col("name").like("SYS%") & ~F.col("name").like("%XDB")).select("db_name", line.alias("line"))
