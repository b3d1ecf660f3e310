"""Row numbers within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierkeep.session import cut

# monotonically_increasing_id keeps the row's place in its task in the lower 33 bits.
_PLACE_BITS = 33


def ranked(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], name: str) -> DataFrame:
    """Number the rows of each group 1, 2, ... in ``order``; NULL group values form a group.

    A window per group would put a hot group into one task. Here rows are range-partitioned on
    (group, order), sorted and written once with their place, so a group spreads over as many
    tasks as its rows need; what was counted before a task's first row of a group comes from a
    table of one row per group and task. Rows equal in ``group`` and ``order`` share a task.
    An empty frame stays empty.
    """
    keys = [*(F.col(g) for g in group), *order]
    placed = cut(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_place", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_place", _PLACE_BITS))
    heads = placed.groupBy(*group, "_part").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # written, so that its size is known before the rows are joined with it and need not move again
    heads = cut(heads.select(
        *(F.col(g).alias(f"_g{i}") for i, g in enumerate(group)),
        F.col("_part").alias("_p"),
        (F.col("_first") - F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - 1).alias("_base"),
    ))
    same = F.col("_part") == F.col("_p")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return placed.join(heads, same).select(*df.columns, (F.col("_place") - F.col("_base")).alias(name))
