"""Bronze batches to the silver dimensions and the player fact."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierkeep.functions.measures import safe_ratio
from tierkeep.functions.texts import pick
from tierkeep.functions.times import AsOf, as_timestamp, day_text, run_stamp
from tierkeep.operators.facts import append_counts, unseen
from tierkeep.operators.latest import latest_per_key
from tierkeep.operators.scd2 import Dimension, merge
from tierkeep.session import cut, scratch
from tierkeep.sources import ledger, registry, tables
from tierkeep.sources.batches import UNREADABLE, landed_rows, read_documents
from tierkeep.sources.schemas import (
    DEFAULT_NAMES,
    PLAYERS_DDL,
    REVIEWS_CORE_DDL,
    STATUS_SUCCESS,
    PayloadNames,
    store_core_ddl,
)

ITEMS = Dimension(
    key="app_id",
    tracked=("price_final_cents", "price_discount_percent", "metacritic_score"),
    surrogate="game_sk",
)
REVIEWS = Dimension(
    key="app_id",
    tracked=("total_reviews", "positive_ratio", "review_score"),
    surrogate="review_sk",
)

KINDS = {"store": registry.ITEM_DIM, "reviews": registry.REVIEW_DIM, "player_stats": registry.PLAYER_FACT}

RESULT_DDL = """
    table_name string, processed bigint, inserted bigint, updated bigint, unchanged bigint, rejected bigint,
    seconds double, success boolean, error string
"""


def succeeded(records: DataFrame) -> DataFrame:
    return records.filter(F.col("status") == STATUS_SUCCESS)


def landed_key(kind: str, names: PayloadNames = DEFAULT_NAMES) -> Column:
    """The item a landed record is about."""
    return F.col("raw_data")[names.item_id] if kind == "store" else F.col("request_params.app_id")


def rejected_rows(landed: DataFrame, kind: str, names: PayloadNames = DEFAULT_NAMES) -> DataFrame:
    """What was landed (``landed_rows``) and cannot be stored, with the ``reason``.

    These are unreadable documents, and successful records without item or without a valid time.
    """
    done = F.col("status") == STATUS_SUCCESS
    reason = (
        F.when(F.col(UNREADABLE).isNotNull(), F.lit("unreadable"))
        .when(done & landed_key(kind, names).isNull(), F.lit("no key"))
        .when(done & F.try_to_timestamp("ingested_at").isNull(), F.lit("no time"))
    )
    rows = landed.select("batch_id", "record_id", "ingested_at", reason.alias("reason"), F.col(UNREADABLE).alias("document"))
    return rows.filter(F.col("reason").isNotNull())


def newest_records(rows: DataFrame) -> DataFrame:
    """The latest record per item; batch and record id break ties, so reruns agree.

    The newest of some records and the newest of others hold the newest of all.
    """
    order = [F.desc("_ingested_at"), F.desc("_source_batch_id"), F.desc("_record_id")]
    return latest_per_key(rows, ["app_id"], order)


def _audit() -> list:
    return [
        F.col("batch_id").alias("_source_batch_id"),
        F.try_to_timestamp("ingested_at").alias("_ingested_at"),
        F.col("record_id").alias("_record_id"),
    ]


def store_rows(records: DataFrame, names: PayloadNames = DEFAULT_NAMES) -> DataFrame:
    """Typed item attributes of the successful store records, latest per item."""
    return newest_records(item_records(records, names)).drop("_record_id")


def item_records(records: DataFrame, names: PayloadNames = DEFAULT_NAMES) -> DataFrame:
    """Typed item attributes of every successful store record that can be stored."""
    raw = F.col("raw_data")
    price, platforms, release = raw["price_overview"], raw["platforms"], raw["release_date"]
    rows = succeeded(records).select(
        raw[names.item_id].alias("app_id"),
        *[raw[c].alias(c) for c in ("name", "type", "is_free", "short_description", "developers", "publishers")],
        price["currency"].alias("price_currency"),
        price["initial"].alias("price_initial_cents"),
        price["final"].alias("price_final_cents"),
        price["discount_percent"].alias("price_discount_percent"),
        *[platforms[c].alias(f"platforms_{c}") for c in ("windows", "mac", "linux")],
        raw["metacritic"]["score"].alias("metacritic_score"),
        pick(raw["categories"], "description").alias("categories"),
        pick(raw["genres"], "description").alias("genres"),
        release["date"].alias("release_date"),
        release["coming_soon"].alias("coming_soon"),
        *_audit(),
    )
    return _storable(rows, "_ingested_at")


def _storable(rows: DataFrame, time: str) -> DataFrame:
    """Rows with an item and a time; the others are those of ``rejected_rows``."""
    return rows.filter(F.col("app_id").isNotNull() & F.col(time).isNotNull())


def review_rows(records: DataFrame) -> DataFrame:
    """Review totals and positive ratio of the successful review records, latest per item."""
    return newest_records(summary_records(records)).drop("_record_id")


def summary_records(records: DataFrame) -> DataFrame:
    """Review totals and positive ratio of every successful review record that can be stored."""
    summary = F.col("raw_data.query_summary")
    totals = ("total_reviews", "total_positive", "total_negative", "review_score", "review_score_desc")
    rows = succeeded(records).select(
        F.col("request_params.app_id").alias("app_id"),
        *[summary[c].alias(c) for c in totals],
        safe_ratio(summary["total_positive"], summary["total_reviews"]).alias("positive_ratio"),
        *_audit(),
    )
    return _storable(rows, "_ingested_at")


def player_rows(records: DataFrame) -> DataFrame:
    """Every successful player count with its snapshot time and day, and its file if known; nothing is deduplicated."""
    taken = F.try_to_timestamp("ingested_at")
    rows = succeeded(records).select(
        F.col("request_params.app_id").alias("app_id"),
        taken.alias("snapshot_timestamp"),
        F.col("raw_data.player_count").alias("player_count"),
        F.col("batch_id").alias("_source_batch_id"),
        day_text(taken).alias("snapshot_date"),
        *[F.col(c) for c in (ledger.FILE,) if c in records.columns],
    )
    return _storable(rows, "snapshot_timestamp")


#: Times that a merge is begun anew because another writer was first.
TRIES = 3


def merge_dimension(spark: SparkSession, source: DataFrame, dim: Dimension, path: str, as_of: AsOf) -> DataFrame:
    """Merge a snapshot into the stored dimension and return the merge's counts."""
    for attempt in range(TRIES):
        base = tables.newest_version(spark, f"{path}/current")
        current = None if base is None else tables.read_current(spark, path, base)
        merged = merge(source, current, dim, as_of)
        try:
            tables.write_merge(merged, dim.key, path, as_of, -1 if base is None else base)
        except tables.Conflict:  # another writer was first: merge into what it wrote
            if attempt == TRIES - 1:
                raise
        else:
            break
    return merged.metrics


#: What tells player rows without a batch id apart.
UNNAMED = ("app_id", "snapshot_timestamp", "player_count")


def append_players(
    spark: SparkSession, source: DataFrame, path: str, as_of: AsOf, since: str | None = None
) -> DataFrame:
    """Append the batches not stored yet and return the counts.

    The rows are narrow and used several times, so they are kept instead of parsing the documents
    again. What was taken is told by a ledger of batches, files and contents beside the fact (see
    ``sources.ledger``), so a batch that is read again is not stored again, one of the same name but
    other content is, and the fact is not searched. Only for rows without batch id it is, in its
    folders from ``since`` on, by default from the source's first day: they are told apart by item,
    time and count, and equal ones are stored once.
    """
    source, batch, ledger_path = cut(source), "_source_batch_id", f"{path.rstrip('/')}-ledger"
    stored = tables.read(spark, path, registry.PLAYER_FACT.ddl) if tables.exists(spark, path) else None
    ledger.recover(spark, ledger_path, stored, batch, UNNAMED, "snapshot_date")
    chosen = ledger.fresh(spark, ledger_path, ledger.units(source, batch, UNNAMED, "snapshot_date"))
    rows = ledger.of_units(source, batch, chosen)
    named = chosen.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("_taken"))

    unnamed = source.filter(F.col(batch).isNull())
    first = unnamed.agg(F.min("snapshot_date")).first()[0]
    if first is not None:
        since = since or first
        existing = stored
        if stored is not None:
            existing = stored.filter(F.col(batch).isNull() & (F.col("snapshot_date") >= since))
        rows = rows.unionByName(unseen(unnamed, existing, batch, UNNAMED))
        others = append_counts(unnamed, existing, batch, UNNAMED).select(F.col("inserted").alias("_others"))
    else:
        others = spark.range(1).select(F.lit(0).cast("bigint").alias("_others"))
    # decided before the write, or the write's own rows would count as seen; one row
    counts = cut(
        source.agg(F.count("*").alias("processed")).crossJoin(named).crossJoin(others).select(
            "processed",
            (F.col("_taken") + F.col("_others")).alias("inserted"),
            F.lit(0).cast("bigint").alias("updated"),
            (F.col("processed") - F.col("_taken") - F.col("_others")).alias("unchanged"),
        )
    )
    new = None if chosen.isEmpty() else ledger.open_units(chosen, ledger_path)
    columns = [c for c in rows.columns if c != ledger.FILE]
    tables.append(rows.select(*columns).withColumn("_created_at", as_timestamp(as_of)), path, registry.PLAYER_FACT.partition_by)
    if new is not None:
        ledger.close_units(chosen, ledger_path, new)
    return counts


def take_in(
    spark: SparkSession,
    kind: str,
    landed: DataFrame,
    silver_root: str,
    as_of: AsOf,
    names: PayloadNames = DEFAULT_NAMES,
    since: str | None = None,
) -> DataFrame:
    """Store what was landed of one kind (``landed_rows``) and return the counts, with the ``rejected`` rows'.

    Rejected rows are appended below ``silver_root/rejected``, so that stored, unchanged, failed and
    rejected records add up to all that was landed. The parsed rows are kept, since both need them.
    """
    landed = cut(landed)
    rejected = reject(landed, kind, silver_root, as_of, names)
    path = KINDS[kind].path(silver_root)
    if kind == "store":
        counts = merge_dimension(spark, store_rows(landed, names), ITEMS, path, as_of)
    elif kind == "reviews":
        counts = merge_dimension(spark, review_rows(landed), REVIEWS, path, as_of)
    else:
        counts = append_players(spark, player_rows(landed), path, as_of, since)
    return counts.withColumn("rejected", F.lit(rejected).cast("bigint"))


def reject(
    landed: DataFrame, kind: str, silver_root: str, as_of: AsOf, names: PayloadNames = DEFAULT_NAMES
) -> int:
    """Append the rejected rows of what was landed and return their number."""
    bad = cut(rejected_rows(landed, kind, names).withColumn("_rejected_at", as_timestamp(as_of)))
    if rejected := bad.count():
        tables.append(bad, f"{silver_root.rstrip('/')}/rejected/{KINDS[kind].name}", ())
    return rejected


def current_views(spark: SparkSession, silver_root: str) -> list[str]:
    """Register the dimensions' current rows as temporary views ``current_<table>``."""
    names = []
    for spec in (registry.ITEM_DIM, registry.REVIEW_DIM):
        rows = tables.read_current(spark, spec.path(silver_root))
        if rows is not None:
            rows.createOrReplaceTempView(f"current_{spec.name}")
            names.append(f"current_{spec.name}")
    return names


def isolated(spark: SparkSession, name: str, step: Callable[[], DataFrame]) -> DataFrame:
    """Run one table's step; a failure becomes a result row and leaves the other tables alone.

    Tables kept during the step are deleted at its end.
    """
    begun = time.monotonic()
    try:
        with scratch(spark):
            row = step().first()
        counts = tuple(row[c] for c in ("processed", "inserted", "updated", "unchanged", "rejected"))
        outcome = (True, None)
    except Exception as problem:  # any failure of one table is reported, not raised
        counts, outcome = (0, 0, 0, 0, 0), (False, str(problem))
    return spark.createDataFrame([(name, *counts, time.monotonic() - begun, *outcome)], RESULT_DDL)


def run_silver(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    *,
    as_of: AsOf | None = None,
    include: tuple[str, ...] = ("items", "reviews", "players"),
    names: PayloadNames = DEFAULT_NAMES,
    multi_line: bool | None = None,
    since: str | None = None,
    folders: Mapping[str, str] | None = None,
) -> DataFrame:
    """Refresh the silver tables; one result row per table, none if ``include`` is empty."""
    stamp = run_stamp() if as_of is None else as_of

    def step(kind: str, ddl: str) -> DataFrame:
        documents = read_documents(spark, landing_path(bronze_root, kind, folders), ddl, multi_line, since)
        return take_in(spark, kind, landed_rows(documents), silver_root, stamp, names, since)

    kinds = {
        "items": ("store", store_core_ddl(names)),
        "reviews": ("reviews", REVIEWS_CORE_DDL),
        "players": ("player_stats", PLAYERS_DDL),
    }
    frame = spark.createDataFrame([], RESULT_DDL)
    for name, (kind, ddl) in kinds.items():
        if name in include:
            frame = frame.unionByName(isolated(spark, KINDS[kind].name, lambda: step(kind, ddl)))
    return frame


def landing_path(bronze_root: str, kind: str, folders: Mapping[str, str] | None = None) -> str:
    """Where batches of a kind land; ``folders`` names other folders by kind."""
    folder = (folders or {}).get(kind, registry.RAW_TABLES[kind].name)
    return f"{bronze_root.rstrip('/')}/Files/bronze/{folder}"


def run_totals(results: DataFrame) -> DataFrame:
    """Totals over a run's result rows, and whether all tables succeeded."""
    return results.agg(
        F.sum("processed").alias("total_processed"),
        F.sum("inserted").alias("total_inserted"),
        F.sum("updated").alias("total_updated"),
        F.sum("unchanged").alias("total_unchanged"),
        F.sum("rejected").alias("total_rejected"),
        F.sum("seconds").alias("seconds"),
        F.bool_and("success").alias("all_successful"),
    )
