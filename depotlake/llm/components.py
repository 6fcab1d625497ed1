"""Connected components of a graph of links, by alternating large and small stars.

Each round points a node's neighbours at the smallest node around (Kiveris et al., Connected
Components in MapReduce and Beyond, 2014) until every component is a star. Rounds grow with the
logarithm of the size. A node with very many links is no bottleneck: its minimum is combined in
each task before the shuffle, and Spark splits its side of the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from depotlake.llm.tables import Scratch

#: Far beyond what any graph needs; a safeguard against an endless loop.
MOST_ROUNDS = 60


def _put(edges: DataFrame, scratch: Scratch, name: str) -> tuple[DataFrame, tuple]:
    """The stored edges, with their number and a sum of their hashes, which tell whether a round changed any."""
    seen = Observation()
    counted = edges.observe(seen, F.count(F.lit(1)).alias("count"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum"))
    stored = scratch.put(counted, name)
    return stored, (seen.get["count"], seen.get["sum"])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").where("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """node and component (the smallest node it reaches) of each node that links (a, b) name.

    Links to itself and repeated links change nothing, and an empty table gives no rows.
    """
    start = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    edges, before = _put(start, scratch, f"{name}-0")
    for number in range(1, MOST_ROUNDS):
        if not before[0]:
            break
        edges, now = _put(_small_star(_large_star(edges)), scratch, f"{name}-{number}")
        scratch.drop(f"{name}-{number - 1}")
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
