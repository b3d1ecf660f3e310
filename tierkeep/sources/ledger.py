"""Which batches an append table has taken, told by their content and not by their names alone.

A unit is what one file holds of one batch. Its digest does not depend on the order of its rows, so a
file that is read again, or lies there twice, is known, while another file that bears the same batch
id is not taken for it. Units are written before the rows (``open/v=N``) and after them
(``taken/v=N``), so a run that broke off in between is recognised. Both are partitioned by the unit's
first day: only days that a source touches are looked up, and never the table itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierkeep.session import cut
from tierkeep.sources import tables
from tierkeep.sources.batches import FILE
from tierkeep.sources.schemas import struct_of

_UNITS_DDL = "batch_id string, rows bigint, digest decimal(38,0), last_day string, v int, first_day string"
_SAME = ["batch_id", "rows", "digest"]


def units(rows: DataFrame, batch: str, content: Sequence[str], day: str) -> DataFrame:
    """One row per batch and file: number of rows, digest of ``content``, first and last day. Rows without batch have none."""
    file = F.col(FILE) if FILE in rows.columns else F.lit(None).cast("string")
    named = rows.filter(F.col(batch).isNotNull()).groupBy(F.col(batch).alias("batch_id"), file.alias(FILE))
    return named.agg(
        F.count("*").alias("rows"),
        F.sum(F.xxhash64(*content).cast("decimal(38,0)")).alias("digest"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
    )


def _read(spark: SparkSession, path: str, part: str) -> DataFrame:
    if tables.newest_version(spark, f"{path}/{part}") is None:
        return spark.createDataFrame([], struct_of(_UNITS_DDL))
    return spark.read.schema(struct_of(_UNITS_DDL)).parquet(f"{path}/{part}")


def taken(spark: SparkSession, path: str) -> DataFrame:
    """All units taken so far."""
    return _read(spark, path, "taken")


def fresh(spark: SparkSession, path: str, found: DataFrame) -> DataFrame:
    """Units of ``found`` not taken yet, written; of equal ones in several files one counts."""
    found = found.groupBy(*_SAME).agg(
        F.min(F.coalesce(FILE, F.lit(""))).alias(FILE), F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day")
    )
    found = cut(found)
    days = found.agg(F.min("first_day").alias("low"), F.max("first_day").alias("high")).first()
    seen = taken(spark, path).filter(F.col("first_day").between(days["low"], days["high"]))
    return cut(found.join(seen.select(*_SAME), _SAME, "left_anti"))


def of_units(rows: DataFrame, batch: str, chosen: DataFrame) -> DataFrame:
    """The rows that belong to the ``chosen`` units."""
    wanted = chosen.select(F.col("batch_id").alias("_unit"), F.col(FILE).alias("_unit_file"))
    file = F.coalesce(F.col(FILE), F.lit("")) if FILE in rows.columns else F.lit("")
    return rows.join(wanted, (F.col(batch) == F.col("_unit")) & (file == F.col("_unit_file")), "left_semi")


def _write(chosen: DataFrame, path: str, part: str, number: int) -> None:
    columns = [*_SAME, "last_day", "first_day"]
    tables.replace(chosen.select(*columns), f"{path}/{part}", ["first_day"], version=number)


def open_units(chosen: DataFrame, path: str) -> int:
    """Note what is about to be appended; returns the number to close it with."""
    last = tables.newest_version(chosen.sparkSession, f"{path}/open")
    number = 0 if last is None else last + 1
    _write(chosen, path, "open", number)
    return number


def close_units(chosen: DataFrame, path: str, number: int) -> None:
    """Note that the append is complete."""
    _write(chosen, path, "taken", number)


def recover(spark: SparkSession, path: str, stored: DataFrame | None, batch: str, content: Sequence[str], day: str) -> None:
    """Settle what an earlier run left open, or begin the ledger of a table that has none.

    An open number without its closing one is compared with the table, of which only the units' days
    are read: if their batches are there in full it is closed as taken, if nothing of them is there it
    is closed empty, and otherwise RuntimeError names a batch that is there in part.
    """
    last_open, last_taken = (tables.newest_version(spark, f"{path}/{p}") for p in ("open", "taken"))
    if last_open is None and last_taken is None:
        if stored is not None:
            begun = cut(units(stored, batch, content, day))
            close_units(begun, path, open_units(begun, path))
        return
    if last_open == last_taken:
        return
    left = cut(_read(spark, path, "open").filter(F.col("v") == last_open))
    days = left.agg(F.min("first_day").alias("low"), F.max("last_day").alias("high")).first()
    sums = [F.sum("rows").alias("rows"), F.sum("digest").alias("digest")]
    before = taken(spark, path).join(left.select("batch_id").distinct(), "batch_id", "left_semi").groupBy("batch_id").agg(*sums)
    whole = left.groupBy("batch_id").agg(*sums)
    there = units(stored.filter(F.col(day).between(days["low"], days["high"])), batch, content, day) if stored is not None else None
    names = {"before": before, "open": whole}
    joined = whole.select("batch_id")
    for name, frame in names.items():
        joined = joined.join(frame.select("batch_id", F.struct("rows", "digest").alias(name)), "batch_id", "left")
    if there is None:
        joined = joined.withColumn("there", F.lit(None).cast(joined.schema["open"].dataType))
    else:
        joined = joined.join(there.groupBy("batch_id").agg(*sums).select("batch_id", F.struct("rows", "digest").alias("there")), "batch_id", "left")
    zero = F.lit(0)
    had = F.struct(F.coalesce("before.rows", zero).alias("rows"), F.coalesce("before.digest", zero.cast("decimal(38,0)")).alias("digest"))
    has = F.struct(F.coalesce("there.rows", zero).alias("rows"), F.coalesce("there.digest", zero.cast("decimal(38,0)")).alias("digest"))
    full = (has["rows"] == had["rows"] + F.col("open.rows")) & (has["digest"] == had["digest"] + F.col("open.digest"))
    none = (has["rows"] == had["rows"]) & (has["digest"] == had["digest"])
    state = cut(joined.select("batch_id", F.when(full, "full").when(none, "none").otherwise("part").alias("state")))
    partly = state.filter("state = 'part'").first()
    if partly is not None:
        raise RuntimeError(f"batch {partly['batch_id']} was appended in part by a run that broke off")
    close_units(left.join(state.filter("state = 'full'"), "batch_id", "left_semi"), path, last_open)
