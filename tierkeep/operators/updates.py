"""Updates of keyed tables as joins: matched update, conditional update, refresh, comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def update_matched(target: DataFrame, updates: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Target with ``columns`` taken from the row of ``updates`` with the same key.

    ``updates`` holds one row per key. A matched NULL overwrites; updates without a target row
    are ignored.
    """
    incoming = updates.select(
        F.col(key).alias("_update_key"), *[F.col(c).alias(f"_update_{c}") for c in columns]
    )
    joined = target.join(incoming, F.col(key) == F.col("_update_key"), "left")
    hit = F.col("_update_key").isNotNull()
    return joined.withColumns(
        {c: F.when(hit, F.col(f"_update_{c}")).otherwise(F.col(c)) for c in columns}
    ).select(*target.columns)


def update_where(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """Set columns on the rows that meet the condition; NULL conditions leave a row alone."""
    return df.withColumns({c: F.when(condition, v).otherwise(F.col(c)) for c, v in values.items()})


def refresh_values(target: DataFrame, fresh: DataFrame, key: str, column: str) -> DataFrame:
    """Target with ``column`` from ``fresh`` where that has a value, else as it was."""
    incoming = fresh.select(F.col(key).alias("_fresh_key"), F.col(column).alias("_fresh"))
    return (
        target.join(incoming, F.col(key) == F.col("_fresh_key"), "left")
        .withColumn(column, F.coalesce("_fresh", column))
        .select(*target.columns)
    )


def changed_between(old: DataFrame, new: DataFrame, key: str, column: str) -> DataFrame:
    """Keys whose column differs between two versions of a table, with both values."""
    left = old.select(F.col(key), F.col(column).alias(f"old_{column}"))
    right = new.select(F.col(key), F.col(column).alias(f"new_{column}"))
    return left.join(right, key).filter(F.col(f"old_{column}") != F.col(f"new_{column}"))
