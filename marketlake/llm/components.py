"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.tables import Scratch


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node with a link; ``component`` is its least node.

    ``edges`` has long columns a and b. Each round links every node's larger neighbours to
    the least one it knows, then its smaller ones, which at least halves the paths; rounds
    go on until the links no longer change and are written to the shared folder, so a lost
    executor never sets back more than one. Only a count and a checksum reach the driver."""
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    links = scratch.write(links, "links")
    before = _signature(links)
    while before[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = scratch.write(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "links")
        now = _signature(links)
        if now == before:
            break
        before = now
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
