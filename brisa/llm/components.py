"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa.llm.text import stored


def _mark(links: DataFrame):
    """Number of links and a sum over them: equal marks mean equal sets of links."""
    r = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return r.n, r.s


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node in ``links`` (u, v long): the smallest node it
    reaches. Loops and repeated links change nothing; no links give no rows.

    Each round hooks every node's larger neighbours to its smallest one and then the
    smaller ones, so paths halve and a round's links never exceed the input's. A node
    with very many neighbours is a skewed join partition, which is split.
    """
    now = stored(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    mark = _mark(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u <> v").distinct(), "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        if (new := _mark(now)) == mark:
            break
        mark = new
    # A star: every node but the smallest of a component points to it.
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(leaves.select(F.col("component").alias("node"), "component").distinct())
