"""Connected components by alternating large and small stars, in DataFrame steps with written edges between."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """links: a, b long. Returns node, root for every node of a link; root is the smallest node it reaches.

    Each round halves the paths at least; a hub's neighbours are never gathered, only their minimum is. The result
    is written as "roots"; the edges between are deleted.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    edges, before, name = scratch.written(edges, "edges-0"), None, 0
    while True:
        facts = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if facts == before or facts[0] == 0:
            ends = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            roots = scratch.written(edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(ends), "roots")
            scratch.drop(f"edges-{name}")
            return roots
        before = facts
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select("u", F.col("m").alias("v")).unionByName(joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = scratch.written(small.distinct(), f"edges-{name + 1}")
        scratch.drop(f"edges-{name}")
        name += 1
