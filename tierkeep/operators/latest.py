"""Keep the newest row per key, or the newest partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """One row per key: the first in the given order. Put tie-breakers last in ``newest_first``.

    Ranking with a limit of one is cut down inside every map task before the shuffle
    (WindowGroupLimit), so a key holding a third of all rows sends one row per task.
    """
    ranking = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_rank", F.row_number().over(ranking)).filter("_rank = 1").drop("_rank")


def latest_partition(
    df: DataFrame,
    partition: Column,
    keys: Sequence[str] = (),
    newest_first: Sequence[Column] = (),
) -> DataFrame:
    """Rows of the newest partition value, one per key when keys are given; empty stays empty.

    The maximum is a scalar subquery, so the scan that follows prunes to one partition.
    """
    newest = df.select(F.max(partition)).scalar()
    rows = df.filter(partition == newest)
    return latest_per_key(rows, keys, newest_first) if keys else rows
