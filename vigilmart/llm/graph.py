"""Connected components of a graph of links, as joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilmart.sources.workspace import settle_tidily


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) for every linked node.

    Alternates large-star and small-star steps: each node hands its larger neighbours, then
    its smaller ones, to the smallest node it knows. The number of rounds grows with the
    logarithm of the graph's diameter. Smallest neighbours come from partial aggregation and
    go back by a join, so a hub's neighbours are never gathered in one group. Each round is
    written to the shared folder. NULL ends and loops are left out.
    """
    edges = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    edges = settle_tidily(edges.where("a is not null and b is not null and a <> b").distinct(), "links")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.join(least, "a")
            .where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        edges = settle_tidily(small, "links")
        now = _state(edges)
        if now == state:
            break
        state = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
