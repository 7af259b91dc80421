"""Connected components of a table of links, in rounds of hooking and contraction.

In a round every node hooks to its smallest neighbour if that is smaller,
chains are shortened by pointer jumping, and the links are rewritten between
the roots. At least half of the nodes that still have links go in each round.
Every step is an aggregation or a join between tables in the shared folder;
nothing is collected and a hub is only a skewed join side that Spark may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.llm.common import scratch


def _roots(links: DataFrame) -> DataFrame:
    """node, root: the smallest node that a chain of smallest neighbours leads to."""
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other")))
    hook = both.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("root"))
    hook = scratch(hook, "hook")
    while True:
        up = hook.select(F.col("node").alias("root"), F.col("root").alias("upper"))
        hook = scratch(hook.join(up, "root").select("node", F.col("upper").alias("root"), (F.col("upper") != F.col("root")).alias("moved")), "jump")
        if hook.filter("moved").isEmpty():
            return hook.select("node", "root")


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node in ``links`` (a, b); a link to itself counts for nothing."""
    links = scratch(links.select("a", "b").filter("a <> b").distinct(), "links")
    out = None
    while not links.isEmpty():
        roots = _roots(links)
        ra, rb = (roots.select(F.col("node").alias(c), F.col("root").alias(f"r{c}")) for c in "ab")
        links = scratch(links.join(ra, "a").join(rb, "b").filter("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "links")
        if out is None:
            out = roots.select("node", F.col("root").alias("component"))
        else:
            later = roots.select(F.col("node").alias("component"), F.col("root").alias("later"))
            out = scratch(out.join(later, "component", "left").select("node", F.coalesce("later", "component").alias("component")), "components")
    return out if out is not None else links.select(F.col("a").alias("node"), F.col("b").alias("component"))
