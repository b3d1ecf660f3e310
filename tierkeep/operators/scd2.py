"""Type-2 history: detect changes, close and open versions, look up a past state."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType
from pyspark.sql.window import WindowSpec

from tierkeep.functions.texts import change_hash, differs
from tierkeep.functions.times import AsOf, as_timestamp, end_of_time
from tierkeep.operators.keys import dense_index
from tierkeep.session import cut

NEW, CHANGED, UNCHANGED = "new", "changed", "unchanged"


@dataclass(frozen=True)
class Dimension:
    """How one dimension is historised."""

    key: str
    tracked: tuple[str, ...]
    surrogate: str
    by_hash: bool = False  # compare md5 of the tracked text instead of the values


@dataclass(frozen=True)
class Merged:
    """Outcome of a merge: the next current slice, the versions it closed, and what it counted.

    ``opened`` are the versions that the slice gains and ``replaced`` the keys of those it loses; both
    are narrow reads of what was written, however large the slice.
    """

    current: DataFrame
    closed: DataFrame
    rejected: DataFrame
    metrics: DataFrame
    opened: DataFrame
    replaced: DataFrame


def classify(source: DataFrame, current: DataFrame, dim: Dimension) -> DataFrame:
    """Source rows with ``_status`` new, changed or unchanged against the current slice.

    Both sides hold one row per key, so the join cannot be skewed by a hot key.
    """
    known = current.select(
        F.col(dim.key).alias("_known_key"),
        *[F.col(c).alias(f"_known_{c}") for c in dim.tracked],
    )
    fresh_values = [F.col(c) for c in dim.tracked]
    known_values = [F.col(f"_known_{c}") for c in dim.tracked]
    if dim.by_hash:
        moved = change_hash(fresh_values) != change_hash(known_values)
    else:
        moved = differs(fresh_values, known_values)
    status = (
        F.when(F.col("_known_key").isNull(), F.lit(NEW))
        .when(moved, F.lit(CHANGED))
        .otherwise(F.lit(UNCHANGED))
    )
    return (
        source.join(known, F.col(dim.key) == F.col("_known_key"), "left")
        .withColumn("_status", status)
        .drop("_known_key", *[f"_known_{c}" for c in dim.tracked])
    )


def _opened(rows: DataFrame, stamp: Column) -> DataFrame:
    return rows.withColumns(
        {
            "valid_from": stamp,
            "valid_to": end_of_time(),
            "is_current": F.lit(True),
            "_created_at": stamp,
            "_updated_at": stamp,
        }
    )


def merge(source: DataFrame, current: DataFrame | None, dim: Dimension, as_of: AsOf) -> Merged:
    """Fold one snapshot (one row per key) into a dimension's current slice.

    Only the current slice takes part; versions closed earlier are never read or rewritten.
    Every output derives from one written classification and one run stamp, so closing and
    opening abut and no output can see a half-applied state. Surrogate keys continue densely,
    changed keys first, each group in key order. Rows without a key are returned as rejected.
    """
    stamp = as_timestamp(as_of)
    keyed = source.filter(F.col(dim.key).isNotNull())
    rejected = source.filter(F.col(dim.key).isNull())
    if current is None:
        tagged = cut(keyed.withColumn("_status", F.lit(NEW)))
        highest = 0
    else:
        tagged = cut(classify(keyed, current, dim))
        highest = current.agg(F.max(dim.surrogate)).first()[0] or 0

    moved = tagged.filter(F.col("_status") != UNCHANGED)
    # "changed" sorts before "new"
    numbered = dense_index(moved, [F.col("_status"), F.col(dim.key)], dim.surrogate, start=highest + 1)
    versions = _opened(numbered.drop("_status"), stamp)
    metrics = tagged.agg(
        F.count("*").alias("processed"),
        F.count_if(F.col("_status") == NEW).alias("inserted"),
        F.count_if(F.col("_status") == CHANGED).alias("updated"),
        F.count_if(F.col("_status") == UNCHANGED).alias("unchanged"),
    )
    if current is None:
        none = versions.filter(F.lit(False))
        return Merged(versions, none, rejected, metrics, versions, none.select(dim.key))

    replaced = numbered.filter(F.col("_status") == CHANGED).select(dim.key)
    kept, closed = parted(current, replaced, dim.key, stamp)
    # a column new in either side is NULL in the other
    next_slice = kept.unionByName(versions, allowMissingColumns=True)
    return Merged(next_slice, closed, rejected, metrics, versions, replaced)


def parted(current: DataFrame, replaced: DataFrame, key: str, as_of: AsOf | Column) -> tuple[DataFrame, DataFrame]:
    """The rows of a slice that stay, and those of the ``replaced`` keys, closed; by one join."""
    stamp = as_of if isinstance(as_of, Column) else as_timestamp(as_of)
    gone = replaced.select(F.col(key).alias("_gone"))
    tagged = current.join(gone, F.col(key) == F.col("_gone"), "left")
    closed = tagged.filter(F.col("_gone").isNotNull()).drop("_gone").withColumns(
        {"valid_to": stamp, "is_current": F.lit(False), "_updated_at": stamp}
    )
    return tagged.filter(F.col("_gone").isNull()).drop("_gone"), closed


def history_from_snapshots(
    snapshots: DataFrame,
    key: str,
    time: str,
    tracked: Sequence[str],
    slice_by: str | None = None,
    ties: Sequence[str | Column] = (),
) -> DataFrame:
    """All versions in one pass over dated snapshots.

    A row starts a version when a tracked column differs from the key's previous row. Adds
    valid_from, valid_to (next start or the end of time) and is_current; keeps the row's columns.
    Rows without key or time are left out, whatever the type of ``time``; ``undated`` returns them.
    Of rows with the same key and time the last in the order of ``ties``, then of the tracked
    columns, counts, so no version has zero length and versions do not depend on the rows' order.

    With a date column and one row per key and day a key's window is small whatever the data
    volume. With timestamps one key may hold a third of all rows: ``slice_by`` (``day``, ``month``,
    ...; ``month`` by default for timestamps) then spreads a key over its calendar slices, and only
    one summary row per key and slice is looked at across slices.
    """
    if slice_by is None and not isinstance(snapshots.schema[time].dataType, DateType):
        slice_by = "month"
    state = F.struct(*[F.col(c) for c in tracked])
    rows = snapshots.filter(F.col(key).isNotNull() & F.col(time).isNotNull())
    order = [F.col(time), *ties, *tracked]
    if slice_by is None:
        ordered = Window.partitionBy(key).orderBy(*order)
        starts = _last_of_moment(rows, time, ordered).withColumn("_before", F.lag(state).over(ordered)).filter(
            F.col("_before").isNull() | ~F.col("_before").eqNullSafe(state)
        )
        ends = F.lead(time).over(ordered)
    else:
        starts, ends = _sliced_starts(rows, key, time, state, slice_by, order)
    closing = F.coalesce(F.col("_next").cast("timestamp"), end_of_time())
    return (
        starts.withColumn("_next", ends)
        .withColumns({"valid_from": F.col(time), "valid_to": closing, "is_current": F.col("_next").isNull()})
        .drop("_before", "_next", "_slice", "_carried", "_later")
    )


def undated(snapshots: DataFrame, key: str, time: str) -> DataFrame:
    """The rows that ``history_from_snapshots`` leaves out."""
    return snapshots.filter(F.col(key).isNull() | F.col(time).isNull())


def _last_of_moment(rows: DataFrame, time: str, ordered: WindowSpec) -> DataFrame:
    """One row per time of each window partition, the last; the window's order begins with the time."""
    following = F.lead(time).over(ordered)
    later = F.col("_following").isNull() | (F.col("_following") != F.col(time))
    return rows.withColumn("_following", following).filter(later).drop("_following")


def _sliced_starts(
    rows: DataFrame, key: str, time: str, state: Column, slice_by: str, order: Sequence[str | Column]
) -> tuple[DataFrame, Column]:
    in_slice = Window.partitionBy(key, "_slice").orderBy(*order)
    sliced = rows.withColumn("_slice", F.date_trunc(slice_by, F.col(time)))
    # version starts as far as one slice can tell: its first row and every change after it;
    # kept once for the two uses below instead of scanning and shuffling the snapshots twice
    local = cut(
        _last_of_moment(sliced, time, in_slice)
        .withColumn("_before", F.lag(state).over(in_slice))
        .filter(F.col("_before").isNull() | ~F.col("_before").eqNullSafe(state))
    )
    summary = local.groupBy(key, "_slice").agg(
        F.min(time).alias("_first"),
        F.min(F.when(F.col("_before").isNotNull(), F.col(time))).alias("_changed"),
        F.min_by(state, F.col(time)).alias("_enters"),
        F.max_by(state, F.col(time)).alias("_leaves"),
    )
    across = Window.partitionBy(key).orderBy("_slice")
    backwards = Window.partitionBy(key).orderBy(F.desc("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    carried = F.lag("_leaves").over(across)
    opening = F.when(
        F.col("_carried").isNull() | ~F.col("_carried").eqNullSafe(F.col("_enters")), F.col("_first")
    ).otherwise(F.col("_changed"))
    seams = (
        summary.withColumn("_carried", carried)
        .withColumn("_opening", opening)
        .withColumn("_later", F.last("_opening", ignorenulls=True).over(backwards))
        .select(key, "_slice", "_carried", "_later")
    )
    starts = local.join(seams, [key, "_slice"]).filter(
        F.col("_before").isNotNull()
        | F.col("_carried").isNull()
        | ~F.col("_carried").eqNullSafe(state)
    )
    return starts, F.coalesce(F.lead(time).over(in_slice), F.col("_later"))


def as_of(history: DataFrame, moment: AsOf) -> DataFrame:
    """The versions valid at one moment (from inclusive, to exclusive)."""
    at = as_timestamp(moment)
    return history.filter((F.col("valid_from") <= at) & (at < F.col("valid_to")))


#: Facts of one key and calendar bucket that one task may get.
PART_ROWS = 1_000_000


def as_of_join(
    facts: DataFrame,
    history: DataFrame,
    key: str,
    time: str,
    bucket: str = "month",
    how: str = "inner",
    fact_columns: Sequence[str] | None = None,
    version_columns: Sequence[str] | None = None,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Each fact row with the version of its key valid at the fact's time (``inner`` or ``left``).

    No fact is paired with versions: facts and versions are put in time order per key and calendar
    bucket, and every fact takes the last version before it. The version in force when a bucket
    begins is found from one summary row per key and bucket. Work grows with the rows, whatever one
    key's share of facts or versions; a finer ``bucket`` (``day``, ``hour``) spreads a hot key more.

    Facts are counted per key and bucket first. Buckets of more than ``part_rows`` facts are dealt
    out by a hash of the fact into parts, each of which gets the bucket's versions; which part a
    fact lies in does not change what it finds. ``fact_columns`` and ``version_columns`` name what
    is wanted of either side (by default all), and no other columns are shuffled.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how}")
    moment = F.col(time).cast("timestamp")
    taken = list(facts.columns if fact_columns is None else fact_columns)
    given = [c for c in (history.columns if version_columns is None else version_columns) if c != key]
    usable = F.col(key).isNotNull() & moment.isNotNull()
    asked = facts.filter(usable).select(
        F.col(key).alias("_key"),
        F.date_trunc(bucket, moment).alias("_bucket"),
        moment.alias("_at"),
        F.lit(2).alias("_kind"),
        F.struct(*taken).alias("_fact"),
    )
    dated = history.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"),
        F.date_trunc(bucket, F.col("valid_from").cast("timestamp")).alias("_bucket"),
        F.col("valid_from").cast("timestamp").alias("_at"),
        F.lit(1).alias("_kind"),
        F.struct(*given, F.col("valid_to").cast("timestamp").alias("_until")).alias("_version"),
    )
    # written: the sizes of the tables below are known when joins are chosen, and facts are counted once
    parts = F.ceil(F.count("*") / F.lit(part_rows)).cast("int")
    wanted = cut(asked.groupBy("_key", "_bucket").agg(parts.alias("_parts")))
    crowded = cut(wanted.filter("_parts > 1"))
    last_started = dated.groupBy("_key", "_bucket").agg(F.max_by("_version", "_at").alias("_last"))
    earlier = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    in_force = (
        wanted.join(last_started, ["_key", "_bucket"], "full")
        .withColumn("_version", F.last("_last", ignorenulls=True).over(earlier))
        .filter(F.col("_parts").isNotNull() & F.col("_version").isNotNull())
        .select("_key", "_bucket", F.col("_bucket").alias("_at"), F.lit(0).alias("_kind"), "_version", "_parts")
    )
    whole = F.coalesce("_parts", F.lit(1))
    dealt = F.pmod(F.xxhash64("_at", "_fact"), whole).cast("int")
    every_part = F.explode(F.sequence(F.lit(0), whole - 1))
    if crowded.isEmpty():  # one part everywhere, so neither side has to be asked
        asked, dated = (side.withColumn("_part", F.lit(0)) for side in (asked, dated))
    else:
        asked = asked.join(crowded, ["_key", "_bucket"], "left").withColumn("_part", dealt).drop("_parts")
        dated = dated.join(crowded, ["_key", "_bucket"], "left").withColumn("_part", every_part).drop("_parts")
    in_force = in_force.withColumn("_part", every_part).drop("_parts")
    so_far = Window.partitionBy("_key", "_bucket", "_part").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    met = (
        asked.unionByName(dated.unionByName(in_force), allowMissingColumns=True)
        .withColumn("_found", F.last("_version", ignorenulls=True).over(so_far))
        .filter("_kind = 2")
    )
    valid = F.coalesce(F.col("_at") < F.col("_found._until"), F.lit(False))
    if how == "inner":
        return met.filter(valid).select("_fact.*", *[F.col("_found")[c].alias(c) for c in given])
    kept = met.select("_fact.*", *[F.when(valid, F.col("_found")[c]).alias(c) for c in given])
    # rows without key or time match nothing and would be one huge group
    return kept.unionByName(facts.filter(~usable).select(*taken), allowMissingColumns=True)
