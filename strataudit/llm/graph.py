"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataudit.llm.common import kept

LINKS_PER_TASK = 1 << 18


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for each node that has a link to another.

    Every round hangs the larger neighbours of a node, then its smaller ones, on the smallest of them, so paths
    shorten as by halving and each component ends as a star. The smallest neighbour is an aggregate with partial sums,
    and what it is joined with can be split, so a node with very many links is no obstacle.
    Null ends and links of a node to itself are ignored; no links give no rows. A round has as many tasks as its links take, whatever the
    number of shuffle partitions, so that rounds over a small graph leave few files.
    """
    edges = kept(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                 .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct())
    before = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if tuple(state) == before or state["n"] == 0:
            return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
                    .union(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())
        before = tuple(state)
        tasks = 2 + state["n"] // LINKS_PER_TASK
        edges = edges.coalesce(tasks)
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(tasks)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = kept(small.coalesce(tasks).union(low.select("u", F.col("m").alias("v")).coalesce(tasks)).distinct().coalesce(tasks))
