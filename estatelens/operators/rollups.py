"""Subtotals, mergeable sketches, set intersection over the fleet, ordered lists and parsed details."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelens.functions.findings import finding, not_internal
from estatelens.functions.sqlcompat import nz_concat

SPACE_KEYS = ("db_name", "tablespace_name", "owner", "segment_type")
#: Log2 of the registers of a distinct-count sketch: standard error about 1.6 %.
HLL_BITS = 12
#: Size of a quantile sketch: rank error about 0.7 %.
KLL_SIZE = 400

# Owners whose synonyms the source never offers for removal.
SYNONYM_KEEPERS = ("PUBLIC", "APEX_LISTENER", "SYS", "SYSTEM")


def space_rollup(segments: DataFrame, keys=SPACE_KEYS) -> DataFrame:
    """Bytes and segments by database, tablespace, owner and type with subtotals by database and tablespace, by database and owner, and in all.

    One scan: rows are expanded to their grouping sets and added up before the
    exchange. ``grouping`` tells a subtotal (a bit set for each key that is
    summed over) from a group whose key is NULL.
    """
    db, ts, owner, kind = (F.col(k) for k in keys)
    sets = [[db, ts, owner, kind], [db, ts, owner], [db, ts], [db, owner], [db], []]
    return (segments.groupingSets(sets, *keys).agg(F.grouping_id().alias("grouping"), F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("segments")))


def daily_sketches(df: DataFrame, time_col: str, item: Column, measure: Column, by=("db_name",)) -> DataFrame:
    """(by, day, n, items, measures): row count, distinct-count sketch of ``item`` and quantile sketch of ``measure`` for each day.

    A day's sketches have a fixed size whatever its rows, are built with partial
    aggregation, and merge with those of other days without reading rows again.
    """
    rows = df.select(*by, F.to_date(time_col).alias("day"), item.alias("__item"), measure.cast("double").alias("__measure"))
    return rows.groupBy(*by, "day").agg(F.count(F.lit(1)).alias("n"), F.hll_sketch_agg("__item", HLL_BITS).alias("items"), F.kll_sketch_agg_double("__measure", KLL_SIZE).alias("measures"))


def merge_sketches(stored: DataFrame, by=("db_name",)) -> DataFrame:
    """Stored sketches of many days as one per group; the result merges again."""
    return stored.groupBy(*by).agg(F.sum("n").alias("n"), F.hll_union_agg("items").alias("items"), F.kll_merge_agg_double("measures").alias("measures"))


def sketch_estimates(sketches: DataFrame, quantiles=(0.5, 0.95)) -> DataFrame:
    """Distinct count and quantiles that the sketches of each row estimate."""
    q = F.array(*[F.lit(float(x)) for x in quantiles])
    return sketches.withColumn("distinct_items", F.hll_sketch_estimate("items")).withColumn("quantiles", F.kll_sketch_get_quantile_double("measures", q)).drop("items", "measures")


def grant_lines(tab_privs: DataFrame, internal_owners: DataFrame) -> DataFrame:
    """One grant statement per (owner, table, grantee, grantable) with its privileges in order, each once.

    Repeated grants go before the list is built, map-side, so a list is as long
    as there are kinds of privileges however often a grantee holds them.
    """
    keys = ["db_name", "owner", "table_name", "grantee", "grantable"]
    p = not_internal(tab_privs.filter(~F.col("owner").like("APEX%")), internal_owners).select(*keys, "privilege").distinct()
    lists = p.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list("privilege")), ",").alias("privileges"))
    end = F.when(F.col("grantable") == "YES", " with grant option;").otherwise(";")
    return lists.select("db_name", nz_concat("grant ", F.col("privileges"), " on ", F.col("owner"), ".", F.col("table_name"), " to ", F.col("grantee"), end).alias("line"))


def in_every_database(df: DataFrame, keys, databases: DataFrame) -> DataFrame:
    """The key combinations that stand in every database of ``databases``.

    An n-way INTERSECT as one grouped count, so the plan is the same for four
    databases and for four thousand; rows of other databases do not count.
    """
    keys = list(keys)
    fleet = databases.select("db_name").distinct()
    total = fleet.agg(F.count(F.lit(1)).alias("__fleet"))
    held = df.join(fleet, "db_name", "left_semi").select(*keys, "db_name").distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("__held"))
    return held.join(F.broadcast(total), F.col("__held") == F.col("__fleet")).select(*keys)          # one row


def orphaned_synonyms(synonyms: DataFrame, tab_privs: DataFrame, exclude_owners=SYNONYM_KEEPERS) -> DataFrame:
    """Synonyms whose target nobody holds a grant on, with the statement that drops them."""
    granted = tab_privs.select("db_name", F.col("owner").alias("table_owner"), "table_name").distinct()
    lost = synonyms.filter(~F.col("owner").isin(*exclude_owners)).join(granted, ["db_name", "table_owner", "table_name"], "left_anti")
    return finding(lost, "orphaned_synonym", owner="owner", object_name="synonym_name", detail=nz_concat(F.col("table_owner"), ".", F.col("table_name")),
                   remedy=nz_concat("drop synonym ", F.col("owner"), ".", F.col("synonym_name"), ";"))


_PAIR = r"([A-Za-z][A-Za-z0-9_ ]*?)\s*[:=]\s*([^,;]+)"


def parsed_details(df: DataFrame, info: str, keep) -> DataFrame:
    """A row for each detail in a text: JSON object or ``name: value`` pairs, typed where the value allows.

    Columns: ``keep``, source (json, pairs or bad), name, value, number, flag,
    bad_record. Text that is neither gives one row with the text in bad_record;
    NULL and blank text give none. Of a JSON object the first level counts, nested values
    stay JSON text; its NULL values give rows without value.
    """
    text = F.trim(F.col(info))
    rows = df.select(*keep, text.alias("__text")).filter(F.col("__text") != "")
    # an array of one object keeps the parser from guessing at broken text: it gives NULL
    as_json = F.when(F.col("__text").startswith("{"), F.from_json("__text", "map<string,string>", {"mode": "PERMISSIVE"}))
    names, values = (F.regexp_extract_all("__text", F.lit(_PAIR), F.lit(k)) for k in (1, 2))
    pairs = F.when(~F.col("__text").startswith("{") & (F.size(names) > 0), F.transform(F.arrays_zip(names.alias("k"), values.alias("v")), lambda p: F.struct(F.trim(p["k"]).alias("key"), F.trim(p["v"]).alias("value"))))
    rows = rows.withColumn("__json", F.map_entries(as_json)).withColumn("__pairs", pairs)
    bad = F.col("__json").isNull() & F.col("__pairs").isNull()
    source = F.when(F.col("__json").isNotNull(), "json").when(F.col("__pairs").isNotNull(), "pairs").otherwise("bad")
    rows = rows.select(*keep, source.alias("source"), F.when(bad, F.col("__text")).alias("bad_record"), F.explode_outer(F.coalesce("__json", "__pairs")).alias("d"))
    rows = rows.filter(F.col("d").isNotNull() | F.col("bad_record").isNotNull())
    value = F.col("d.value")
    return rows.select(*keep, "source", F.col("d.key").alias("name"), value.alias("value"), value.try_cast("bigint").alias("number"),
                       F.when(F.lower(value).isin("true", "yes"), True).when(F.lower(value).isin("false", "no"), False).alias("flag"), "bad_record")
