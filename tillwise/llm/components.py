"""Connected components of a graph given by its links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.shared import checkpointed

MAX_ROUNDS = 60


def _large_star(links: DataFrame) -> DataFrame:
    """Every node's larger neighbours go to the smallest node of its neighbourhood."""
    both = links.select("u", "v").unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours go to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """One row (node, root) per node that is no root; links have columns a and b of long.

    Joins and aggregates by node that combine before they shuffle: a node with
    very many links is split by adaptive execution. Every round is checkpointed.
    """
    links = checkpointed(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    state = None
    for _ in range(MAX_ROUNDS):
        links = checkpointed(_small_star(_large_star(links).distinct()).distinct())
        seen = links.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")
        ).head()
        if tuple(seen) == state:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = tuple(seen)
    raise RuntimeError(f"no components after {MAX_ROUNDS} rounds")
