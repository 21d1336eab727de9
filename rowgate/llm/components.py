"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowgate.staging import Staging


def _pulled(links: DataFrame, node: str, other: str) -> DataFrame:
    """Each link with the smallest neighbour of its ``node`` (the node itself included) as ``low``."""
    low = links.groupBy(node).agg(F.min(other).alias("low")).withColumn("low", F.least("low", node))
    return links.join(low, node)


def _large_star(links: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the node's smallest neighbour instead."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return _pulled(both, "a", "b").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every neighbour below a node, and the node, are linked to the smallest of them."""
    pulled = _pulled(links, "a", "b")
    near = pulled.select(F.col("b").alias("a"), F.col("low").alias("b"))
    own = pulled.select("a", F.col("low").alias("b"))
    return near.union(own).where("a <> b").distinct()


def components(links: DataFrame, staging: Staging, name: str, most_rounds: int = 60) -> DataFrame:
    """``node, component`` for all nodes of ``links`` (long columns ``a``, ``b``), by smallest node.

    A node with no link to another is not listed. Each round groups and joins by node, with minima
    combined before the shuffle, and is written to the shared folder, where it replaces the one before; the
    loop ends when a round changes nothing. A hub's links are joined to one row, so adaptive execution can split them.
    Nothing is collected but a row count and a checksum.
    """
    high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    current = staging.keep(links.where("a <> b").select(high, low).distinct(), f"{name}-0")
    seen = None
    for number in range(1, most_rounds + 1):
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        seen = state
        current = staging.keep(_small_star(_large_star(current)), f"{name}-{number}")
        staging.forget(f"{name}-{number - 1}")
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
