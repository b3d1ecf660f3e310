"""Numeric column expressions shared by the silver and gold tables. All stay inside codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents_to_amount(cents: Column) -> Column:
    return (cents / F.lit(100)).cast("double")


def cents_to_decimal(cents: Column) -> Column:
    """Exact currency amount for callers that add up money."""
    return (cents.cast("decimal(12,0)") / F.lit(100).cast("decimal(3,0)")).cast("decimal(10,2)")


def is_above(value: Column, limit: float = 0) -> Column:
    """True above the limit; false otherwise, also for NULL."""
    return F.coalesce(value > F.lit(limit), F.lit(False))


def step_label(
    value: Column,
    zero_label: str,
    steps: Sequence[tuple[float, str]],
    top_label: str,
    null_label: str | None = None,
) -> Column:
    """Name the range a value lies in; ``steps`` are (exclusive upper limit, label), ascending.

    NULL gets ``top_label`` unless ``null_label`` is given.
    """
    chain = F.when(value.isNull(), F.lit(top_label if null_label is None else null_label))
    chain = chain.when(value == 0, F.lit(zero_label))
    for limit, label in steps:
        chain = chain.when(value < F.lit(limit), F.lit(label))
    return chain.otherwise(F.lit(top_label))


# Discount tiers by percent.
DISCOUNT_ZERO = "No Discount"
DISCOUNT_STEPS = (
    (25, "Small (1-24%)"),
    (50, "Medium (25-49%)"),
    (75, "Large (50-74%)"),
)
DISCOUNT_TOP = "Huge (75%+)"


def discount_tier(percent: Column, null_label: str | None = None) -> Column:
    return step_label(percent, DISCOUNT_ZERO, DISCOUNT_STEPS, DISCOUNT_TOP, null_label)


def safe_ratio(part: Column, total: Column) -> Column:
    """part / total, NULL unless the total is positive."""
    return F.when(total > 0, part.cast("double") / total.cast("double"))


def percent_of(part: Column, total: Column, digits: int = 2) -> Column:
    """Rounded percentage, NULL for a zero total."""
    return F.round(F.try_divide(part.cast("double"), total.cast("double")) * 100, digits)


def popularity(audience: Column, ratio: Column) -> Column:
    """Log-scaled audience weighted by rating; no audience counts 0, no rating counts one half."""
    reach = F.log1p(F.coalesce(audience, F.lit(0)))
    weight = F.coalesce(ratio, F.lit(0.5))
    return F.round(reach * weight * 100, 2)


def count_where(condition: Column) -> Column:
    """Rows for which the condition holds; 0, not NULL, for none."""
    return F.count_if(F.coalesce(condition, F.lit(False)))
