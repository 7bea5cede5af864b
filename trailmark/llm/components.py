"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.llm.common import stored


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Links (a, b), a > b, hung on the least neighbour: of each node's larger neighbours if large,
    else of its smaller ones and itself. Groups are only ever reduced to a least id, which combines
    ahead of the shuffle; a node with many links is split by the skew join.
    """
    if large:
        pairs = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        hung = pairs.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = links.groupBy("a").agg(F.min("b").alias("m"))
        met = links.join(least, "a")
        hung = met.select(F.col("b").alias("a"), F.col("m").alias("b")).union(met.select("a", F.col("m").alias("b")))
    return hung.where(F.col("a") > F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b): the least node that can be reached from it.

    Null ends and links of a node to itself are ignored. Each round is written to the shared
    folder. Rounds grow with the logarithm of a component's diameter.
    """
    ordered = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links, before = stored(ordered.distinct(), "links"), None
    while True:
        links = stored(_stars(_stars(links, large=True), large=False), "stars")
        # The links stand still when their number and the sum of their hashes do.
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
