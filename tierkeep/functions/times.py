"""Time columns: run stamps, day text, epoch seconds, weekdays."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# The open end of a validity interval and the text form of a snapshot day.
END_OF_TIME = "9999-12-31 23:59:59"
DAY_FORMAT = "yyyy-MM-dd"

AsOf = str | datetime | date | Column


def run_stamp() -> str:
    """The current UTC instant as text: taken once per run and passed to every step."""
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")


def as_timestamp(value: AsOf) -> Column:
    """One timestamp for a whole run. Text and datetimes are read in the session time zone."""
    if isinstance(value, Column):
        return value.cast("timestamp")
    if isinstance(value, datetime):
        if value.tzinfo is not None:
            return F.lit(value.isoformat()).cast("timestamp")
        value = value.isoformat(sep=" ")
    return F.lit(str(value)).cast("timestamp")


def end_of_time() -> Column:
    return F.lit(END_OF_TIME).cast("timestamp")


def day_text(column: Column) -> Column:
    """A timestamp's day as text, the form used for partition columns."""
    return F.date_format(column, DAY_FORMAT)


def from_epoch_seconds(column: Column) -> Column:
    return F.timestamp_seconds(column)


def weekday_index(column: Column) -> Column:
    """0 for Monday to 6 for Sunday."""
    return F.weekday(column)
