"""Append only what is not there yet."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _values(column: str, identity: Sequence[str]) -> list[Column]:
    """What tells rows apart: ``column`` and, only where it is NULL, the columns ``identity``."""
    return [F.col(column), *(F.when(F.col(column).isNull(), F.col(c)) for c in identity)]


def _all_equal(left: Sequence[Column], right: Sequence[Column]) -> Column:
    return reduce(Column.__and__, (a.eqNullSafe(b) for a, b in zip(left, right)))


def unseen(source: DataFrame, existing: DataFrame | None, column: str, identity: Sequence[str] = ()) -> DataFrame:
    """Source rows whose value (a key, a batch id) does not occur in ``existing``; NULL equals NULL.

    With ``identity``, rows without a value are told apart by these columns, NULL being equal to
    NULL, and of equal ones in ``source`` one counts: so it does not matter how they come grouped.
    """
    if identity:
        unnamed = source.filter(F.col(column).isNull()).dropDuplicates(list(identity))
        source = source.filter(F.col(column).isNotNull()).union(unnamed)
    if existing is None:
        return source
    names = [f"_seen{i}" for i in range(len(identity) + 1)]
    seen = existing.select(*(v.alias(n) for v, n in zip(_values(column, identity), names))).distinct()
    return source.join(seen, _all_equal(_values(column, identity), [F.col(n) for n in names]), "left_anti")


def known(source: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """Source rows whose value occurs in ``wanted``: an IN list that is a table."""
    return source.join(wanted.select(column).distinct(), column, "left_semi")


def append_counts(
    source: DataFrame, existing: DataFrame | None, column: str, identity: Sequence[str] = ()
) -> DataFrame:
    """One row: processed, inserted and unchanged, decided per batch and not per row.

    Rows are added up per batch first, so the join is between small frames. With ``identity``, rows
    without a batch are decided as ``unseen`` does; what repeats among them counts as unchanged.
    """
    names = [f"_value{i}" for i in range(len(identity) + 1)]
    values = [v.alias(n) for v, n in zip(_values(column, identity), names)]
    batches = source.select(*values).groupBy(*names).agg(F.count("*").alias("rows"))
    if existing is None:
        tagged = batches.withColumn("seen", F.lit(False))
    else:
        others = [f"_other{i}" for i in range(len(names))]
        seen = existing.select(*(v.alias(n) for v, n in zip(_values(column, identity), others))).distinct()
        seen = seen.withColumn("_seen", F.lit(True))
        same = _all_equal([F.col(n) for n in names], [F.col(n) for n in others])
        tagged = batches.join(seen, same, "left").withColumn("seen", F.col("_seen").isNotNull())
    fresh = F.when(F.col(names[0]).isNull(), F.lit(1)).otherwise(F.col("rows")) if identity else F.col("rows")
    total = F.coalesce(F.sum("rows"), F.lit(0))
    inserted = F.coalesce(F.sum(F.when(~F.col("seen"), fresh)), F.lit(0))
    return tagged.agg(
        total.alias("processed"),
        inserted.alias("inserted"),
        F.lit(0).cast("bigint").alias("updated"),
        (total - inserted).alias("unchanged"),
    )
