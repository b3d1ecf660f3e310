"""File layout of partitioned writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def by_folder(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows brought together per output folder, so a write makes few files and not tasks x folders.

    Rebalancing lets adaptive execution merge small folders into one task and split a folder that
    holds most rows over many.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df
