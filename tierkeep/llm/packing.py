"""Carrying columns that an operator does not read through it, whatever their names are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_REST = "_rest"


def _own(name: str) -> Column:
    return F.col(f"`{name}`")


def packed(docs: DataFrame, read: Sequence[str]) -> DataFrame:
    """The columns ``read``, and all others as fields of one struct, so that no name can clash."""
    rest = [c for c in docs.columns if c not in read]
    return docs.select(*read, *([F.struct(*map(_own, rest)).alias(_REST)] if rest else []))


def unpacked(df: DataFrame, columns: Sequence[str], read: Sequence[str]) -> list[Column]:
    """The ``columns`` of the frame that was packed, in their order."""
    return [_own(c) if c in read else F.col(_REST).getField(c).alias(c) for c in columns]
