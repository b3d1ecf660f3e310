"""Connected components of a graph of any shape, with its links as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierkeep.session import cut


def _with_least(links: DataFrame) -> DataFrame:
    """Every (node, neighbour) of both directions with ``_m``, the least of the node and its neighbours."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        links.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("_v"))
    least = least.select(F.col("u").alias("_u"), F.least("u", "_v").alias("_m"))
    return both.join(least, F.col("u") == F.col("_u")).select("u", "v", "_m")


def _tidy(links: DataFrame) -> DataFrame:
    """Links between different nodes, the larger first, each once."""
    return links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """``node`` and ``component``, the least node that it reaches, for every node with a link.

    ``links`` has ``a`` and ``b`` (bigint), in any direction, repeated or not; rows with NULL are
    left out, as are nodes linked to themselves only. Each round hangs all larger neighbours of a
    node on the least one (large star), then all smaller ones (small star); the rounds needed grow
    with the logarithm of the longest path. The links never outnumber those at the start, no node's
    neighbours are gathered, and every round's links are written, so a lost executor costs a re-read.
    Raises if ``rounds`` do not suffice.
    """
    now = cut(_tidy(links.where("a is not null and b is not null").select("a", "b")))
    for _ in range(rounds):
        large = _with_least(now).where("v > u").select(F.col("v").alias("a"), F.col("_m").alias("b"))
        large = _tidy(large)
        least = large.groupBy("a").agg(F.min("b").alias("_m")).withColumnRenamed("a", "_a")
        joined = large.join(least, F.col("a") == F.col("_a"))
        small = joined.select(F.when(F.col("b") == F.col("_m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("_m").alias("b"))
        after = cut(_tidy(small))
        # the links are stars once no node is both the larger and the smaller end of a link, or has two
        roots = after.select(F.col("b").alias("_b")).distinct()
        chained = after.join(roots, F.col("a") == F.col("_b"), "left_semi")
        twice = after.groupBy("a").count().where("count > 1").select("a")
        now = after
        if chained.select("a").union(twice).isEmpty():
            break
    else:
        raise RuntimeError(f"links are not settled after {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
