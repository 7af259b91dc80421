"""Mixing sources to target weights by Sainte-Laguë apportionment.

Targets share all words by weight, stop at ``max_repeats`` times a source's
own words, and the excess is shared again by weight. Blocks of ``block_words``
words are then the seats: after every shard of ``shard_blocks`` blocks the
seats so far go to the highest quotients target / (2k + 1), and a shard's quota
is what each source gained (the method never takes a seat back as the house
grows). A source's documents stand in seeded order; of the blocks cut from that
order a seeded, evenly spaced selection takes the quota, whole passes first.

Words before a document come from two levels (totals of hash buckets, then a
window inside one bucket), so no source is gathered in one task and a row is
shuffled once, with the columns that are kept; the words taken
follow in closed form from a document's first and last word.

Defined results: null text has no words; null source is a source of its own and
comes last; a source without words has target 0; blocks have ``block_words``
words, or fewer where a source is small, so that each target is worth
``SMALLEST_SEATS`` seats or its seats are single words; the order follows doc_id and
text together, ties go by doc_id, then size, and rows equal in both are interchangeable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estatelens.llm.common import scratch

WORDS = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in ascending order, repeating.
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK_WORDS = 32
SHARD_BLOCKS = 131_072
#: Seats that the smallest target, or source, is worth at least; blocks shrink to that end.
SMALLEST_SEATS = 32
SEED = 42
#: Hex digits of the order that make a bucket: 4096 buckets a source.
BUCKET_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORDS)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """source, rank, weight, source_size, target from one row (source, source_size) per source.

    Sources in the order of cap / weight: those before the first whose equal
    share fits under its cap are capped. One row per source, so the windows are small.
    """
    by_name, everything = Window.orderBy(F.col("source").asc_nulls_last()), Window.partitionBy()
    s = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")).cast("double")
    s = s.withColumn("weight", weight).withColumn("cap", (F.col("source_size") * max_repeats).cast("double"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before, after = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing)
    s = s.withColumn("level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct((F.col("cap") / F.col("weight")).alias("r"), "rank", "level"))
    s = s.withColumn("share", F.min(fits).over(everything)["level"])
    return s.select("source", "rank", "weight", "source_size", F.least("cap", F.col("share") * F.col("weight")).alias("target"))


def quotas(goal: DataFrame, block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """shard, rank, quota: blocks that each shard takes from each source.

    A source's seats lie within share * (1 +- S / 2N) + 1 / 2 for S sources and
    N seats, as each rounds by half a seat at most; only seats in that range
    have to be ranked by quotient, about two a source.
    """
    everything = Window.partitionBy()
    g = (goal.withColumn("words", F.sum("target").over(everything)).withColumn("n_sources", F.count("*").over(everything))
         .withColumn("seats", F.round(F.col("words") / block_words).cast("long")).filter("seats > 0"))
    g = (g.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(seats - 1) div {shard_blocks}"))))
         .withColumn("house", F.least("seats", (F.col("shard") + 1) * shard_blocks))
         .withColumn("even", F.col("house") * F.col("target") / F.col("words"))
         .withColumn("slack", F.col("n_sources") / (2 * F.col("house")))
         .withColumn("sure", F.greatest(F.lit(0), F.ceil(F.col("even") * (1 - F.col("slack")) - 0.5) - 1).cast("long"))
         .withColumn("most", F.ceil(F.col("even") * (1 + F.col("slack")) + 0.5).cast("long")))
    in_shard = Window.partitionBy("shard")
    g = g.withColumn("open", F.col("house") - F.sum("sure").over(in_shard))
    seat = g.filter("target > 0").withColumn("k", F.explode(F.sequence("sure", "most"))).withColumn("quotient", F.col("target") / (2 * F.col("k") + 1))
    won = (seat.withColumn("place", F.row_number().over(in_shard.orderBy(F.desc("quotient"), "rank", "k")))
           .filter("place <= open").groupBy("shard", "rank").agg(F.count("*").alias("won")))
    house = g.join(won, ["shard", "rank"], "left").withColumn("so_far", F.col("sure") + F.coalesce("won", F.lit(0)))
    earlier = Window.partitionBy("rank").orderBy("shard")
    return house.select("shard", "rank", (F.col("so_far") - F.lag("so_far", 1, 0).over(earlier)).alias("quota"))


def _taken_before(words: str) -> str:
    """Words taken of the first ``words`` words of a source: whole blocks, then the open block as often as it is selected."""
    k = f"({words} div block)"
    seats = lambda b: f"((CAST({b} AS DECIMAL(19,0)) * CAST(quota AS DECIMAL(18,0)) + shift) div n_blocks)"
    return f"({seats(k)} * block + ({words} % block) * ({seats(f'({k} + 1)')} - {seats(k)}))"


def mix(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS,
        block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS, seed: int = SEED) -> DataFrame:
    """``keep`` columns, size, source_size, target and taken of every row of ``docs`` (doc_id, text, source), and copies.

    ``taken`` counts the words of the selected blocks, block by block.
    ``copies`` is for users who take documents whole: how often the block with
    the document's first word is selected.
    """
    # the text is part of the seed's input, so that an id (or null) shared by very many rows is spread over the buckets
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.xxhash64("text").cast("string")))
    place = ["none", "src", "bucket"]                       # null sources by a flag, so that window and join deal rows out alike
    rows = (docs.select(*[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)], F.col("doc_id").alias("id"), F.col("source").isNull().alias("none"),
                        F.coalesce("source", F.lit("")).alias("src"), word_count(F.col("text")).alias("size"), order.alias("order"))
            .withColumn("bucket", F.substring("order", 1, BUCKET_DIGITS)))
    buckets = scratch(rows.groupBy(*place).agg(F.sum("size").alias("n")), "mix-buckets")
    sources = buckets.groupBy(F.when(~F.col("none"), F.col("src")).alias("source")).agg(F.sum("n").alias("source_size"))
    earlier = Window.partitionBy("none", "src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select(*place, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    goal = scratch(targets(sources, weights, max_repeats), "mix-goal")
    # a small source is as many seats as a large one has at least, down to seats of one word
    least = goal.filter("target > 0").agg(F.min(F.least("target", F.col("source_size").cast("double")))).first()[0]
    widest, block_words = block_words, max(1, min(block_words, int((least or 0) // SMALLEST_SEATS)))
    shard_blocks = shard_blocks * widest // block_words        # shards of as many words as before
    total = quotas(goal, block_words, shard_blocks).groupBy("rank").agg(F.sum("quota").alias("seats"))
    shift = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce("source", F.lit("")))), 1, 12), 16, 10).cast("long")
    goal = (goal.join(total, "rank", "left").withColumn("block", F.lit(block_words).cast("long"))
            .withColumn("n_blocks", F.greatest(F.lit(1), F.expr(f"(source_size + {block_words - 1}) div {block_words}")))
            .withColumn("quota", F.least(F.coalesce("seats", F.lit(0)), F.col("n_blocks") * max_repeats))
            .withColumn("shift", F.pmod(shift, F.col("n_blocks")))
            .select(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("src"), "source_size", "target", "block", "n_blocks", "quota", "shift"))
    inside = Window.partitionBy(*place).orderBy("order", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(buckets, place).join(goal, ["none", "src"])
    placed = placed.withColumn("a", F.col("base") + F.col("within")).withColumn("z", F.col("a") + F.col("size"))
    taken = F.expr(f"{_taken_before('z')} - {_taken_before('a')}").cast("long")
    first = F.expr(f"{_taken_before('(a - a % block + block)')} - {_taken_before('(a - a % block)')}") / F.col("block")
    return placed.select(*[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)], "size", "source_size", "target", taken.alias("taken"),
                         first.cast("int").alias("copies"))
