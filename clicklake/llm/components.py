"""Connected components of a table of links, by alternating star contractions.

A large-star step hangs every larger neighbour of a vertex onto the smallest vertex of
its neighbourhood, a small-star step the smaller ones; both keep the components and the
number of rounds grows with the logarithm of the number of links. Every step is a grouped
minimum and a join that Spark can split where one vertex has a large share of the links,
and its result is written, so that neither lineage nor driver grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from clicklake.llm.common import written


def _kept(links: DataFrame) -> tuple[DataFrame, tuple]:
    """The links, written, with their number and a sum of hashes, both taken while they are written."""
    seen = Observation()
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    rows = written(links.observe(seen, F.count(F.lit(1)).alias("rows"), total.alias("total")))
    return rows, (seen.get["rows"], seen.get["total"])


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    hung = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return hung.distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """From links with a > b."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    hung = links.join(least, "a").where("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return hung.union(least.select("a", F.col("least").alias("b"))).distinct()


def contracted(links: DataFrame) -> DataFrame:
    """member, component: one contraction. Members that share a component are connected, but not all that are share one."""
    edge = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edge = written(_small_star(_large_star(edge)))
    return edge.groupBy(F.col("a").alias("member")).agg(F.min("b").alias("component"))


def connected(links: DataFrame) -> DataFrame:
    """member, component (the smallest member reachable) from links of columns a and b.

    Members without a link to another are not in the result. Nulls, loops,
    repeated and reversed links are allowed and change nothing.
    """
    edge, state = _kept(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while state[0]:
        before = state
        edge, state = _kept(_small_star(_large_star(edge)))
        if before == state:
            break
    roots = edge.select(F.col("b").alias("member"), F.col("b").alias("component")).distinct()
    return edge.select(F.col("a").alias("member"), F.col("b").alias("component")).union(roots)
