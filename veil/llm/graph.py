"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veil.llm.common import spread_join, stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges (a, b)``; the root is the smallest node that can be reached.

    Each round links the larger neighbours of a node to its smallest one (large star), then all smaller
    ones (small star). Every round is a written table, so lineage stays short. The number of rounds
    grows with the logarithm of the longest path.
    """
    links = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct(),
        "links",
    )
    before = _mark(links)
    while before[0]:
        links = stored(_small_star(stored(_large_star(links), "large-star")), "small-star")
        after = _mark(links)
        if after == before:
            break
        before = after
    roots = links.select(F.col("root").alias("node"), "root").distinct()
    return links.unionByName(roots)


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("node", "root"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select(F.col("node").alias("at"), F.col("root").alias("next")).unionByName(
        links.select(F.col("root").alias("at"), F.col("node").alias("next"))
    )
    least = F.least("at", F.min("next")).alias("least")
    larger = F.count_if(F.col("next") > F.col("at")).alias("larger")
    hubs = stored(both.groupBy("at").agg(least, larger).where("larger > 0"), "hubs")
    up = links.select(F.col("root").alias("at"), F.col("node").alias("next"))
    return spread_join(up, hubs, "at", "larger").select(F.col("next").alias("node"), F.col("least").alias("root")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    hubs = stored(links.groupBy("node").agg(F.min("root").alias("least"), F.count(F.lit(1)).alias("n")), "hubs")
    moved = spread_join(links, hubs.where("n > 1"), "node", "n").where("root <> least")
    return (
        moved.select(F.col("root").alias("node"), F.col("least").alias("root"))
        .unionByName(hubs.select("node", F.col("least").alias("root")))
        .distinct()
    )
