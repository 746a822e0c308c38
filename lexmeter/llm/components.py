"""Connected components of a graph given as links, by alternating stars.

Each round links every node's larger neighbours to its smallest one (large star), then its
smaller neighbours and itself (small star), until nothing changes; the rounds grow
with the logarithm of the longest chain. What a join reads is written first, so
adaptive execution can split the rows of a node with very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmeter.sources.scratch import written


def _lowest(links: DataFrame, node: str, other: str, path: str) -> DataFrame:
    """The smallest neighbour ``low`` of each node."""
    low = links.groupBy(F.col(node).alias("node")).agg(F.min(other).alias("low"))
    return written(low, path)


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("a"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame, folder: str) -> DataFrame:
    """``node`` and ``root``, the smallest node it is linked to, from links ``a`` and ``b``.

    Nodes without a link to another node have no row.
    """
    tidy = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = written(tidy.distinct(), f"{folder}/links")
    before, number = None, 0
    while before != (now := _state(links)):
        before, path = now, f"{folder}/round{number}"
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = _lowest(both, "a", "b", f"{path}/large_low")
        low = low.select("node", F.least("node", "low").alias("low"))
        large = links.join(low, F.col("b") == F.col("node")).select("a", F.col("low").alias("b"))
        large = written(large.distinct(), f"{path}/large")
        low = _lowest(large, "a", "b", f"{path}/small_low")
        lower = large.join(low, F.col("a") == F.col("node"))
        small = lower.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        itself = low.select(F.col("node").alias("a"), F.col("low").alias("b"))
        links = written(small.unionByName(itself).distinct(), f"{path}/small")
        number += 1
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
