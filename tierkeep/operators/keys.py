"""Dense row numbers without a single-task window, and fixed-size chunks built on them."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierkeep.session import cut

# monotonically_increasing_id keeps the row's place in its partition in the lower 33 bits.
_ROW_BITS = 33


def dense_index(
    df: DataFrame,
    order: list[Column],
    name: str,
    start: int = 0,
    partitions: int | None = None,
) -> DataFrame:
    """Number rows ``start, start+1, ...`` in the given order, spread over all tasks.

    Rows are range-partitioned and sorted, then written, so that a lost executor cannot change the
    numbering. Only one row count per partition comes to the driver. ``order`` should
    be unique (add tie-breakers): equal tuples share a range, and so a task. Adaptive execution
    merges small ranges unless a number of ``partitions`` is given.
    """
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    placed = cut(
        ranged.sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    part = F.shiftright(F.col("_place"), _ROW_BITS).cast("int")
    sizes = {r["part"]: r["n"] for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    last = max(sizes, default=0)
    firsts = list(accumulate((sizes.get(p, 0) for p in range(last)), initial=start))
    within = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    first = F.element_at(F.array(*[F.lit(f).cast("bigint") for f in firsts]), part + 1)
    return placed.withColumn(name, first + within).drop("_place")


def assign_chunks(df: DataFrame, order: list[Column], size: int = 100, name: str = "chunk") -> DataFrame:
    """Put rows into consecutive chunks of ``size`` in the given order."""
    numbered = dense_index(df, order, "_index")
    return numbered.withColumn(name, F.floor(F.col("_index") / size).cast("bigint")).drop("_index")
