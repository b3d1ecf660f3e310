"""Row counts, version census and retention."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierkeep.functions.times import AsOf, as_timestamp

HEALTH_DDL = "table_name string, records bigint, success boolean, error string"


def table_health(spark: SparkSession, tables: Mapping[str, Callable[[], DataFrame]]) -> DataFrame:
    """Row count per table; a table that cannot be opened or read gets its error instead.

    Tables are counted one by one, so that a damaged one leaves the others' counts alone.
    """
    found = []
    for name, open_table in tables.items():
        try:
            found.append((name, open_table().count(), True, None))
        except Exception as problem:  # reported per table
            found.append((name, None, False, str(problem)))
    return spark.createDataFrame(found, HEALTH_DDL)


def version_census(history: DataFrame) -> DataFrame:
    """Current and historical version counts."""
    return history.groupBy("is_current").agg(F.count("*").alias("versions"))


def within_retention(df: DataFrame, day: Column, as_of: AsOf, days: int | None) -> DataFrame:
    """Rows younger than the retention; None keeps all. On a partition column whole folders drop out."""
    if days is None:
        return df
    return df.filter(day >= F.date_sub(as_timestamp(as_of).cast("date"), days))
