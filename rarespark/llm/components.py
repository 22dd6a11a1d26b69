"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rarespark.session import cut_lineage


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def _least(links: DataFrame) -> DataFrame:
    """Least neighbour of each ``a``, itself included; written so that joins can split hot nodes."""
    return cut_lineage(links.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least")), "least")


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of a node are linked to its least neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.join(_least(both), "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = _least(down)
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links (a, b)``; ``root`` is the least node reachable.

    Each round is two aggregations and joins over the links, which shrink towards one star
    per component; the number of rounds grows with the logarithm of the longest chain.
    Nodes never come to the driver. Loops and repeated links are allowed, nulls are not.
    """
    links = cut_lineage(links.where("a <> b").select("a", "b").distinct(), "links")
    state = _state(links)
    while True:
        large = _large_star(links).where("a <> b").distinct()
        links = cut_lineage(_small_star(cut_lineage(large, "large")).where("a <> b").distinct(), "links")
        after = _state(links)
        if after == state:
            break
        state = after
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
