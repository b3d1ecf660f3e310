"""Take newly landed batch documents into the silver tables, each file once.

The same outcome as a full silver run, fed by a file stream: its checkpoint remembers which files were
read, so landed history is not parsed again. Micro-batches of the dimensions only put typed rows aside;
the run folds them in once, at its end, with the newest record per item of all that was ever read. So
neither the files' order, nor how they fall into micro-batches, nor a late file changes a dimension: it
gets the versions that a full run at the same time gives it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierkeep.functions.times import AsOf, run_stamp
from tierkeep.plans.silver import (
    ITEMS,
    KINDS,
    REVIEWS,
    item_records,
    landing_path,
    merge_dimension,
    newest_records,
    reject,
    summary_records,
    take_in,
)
from tierkeep.session import cut, scratch
from tierkeep.sources import tables
from tierkeep.sources.batches import FILE, UNREADABLE, document_schema, landed_rows
from tierkeep.sources.schemas import DEFAULT_NAMES, PLAYERS_DDL, REVIEWS_CORE_DDL, PayloadNames, store_core_ddl

COUNTS = ("processed", "inserted", "updated", "unchanged", "rejected")


def ingest_new(
    spark: SparkSession,
    kind: str,
    bronze_root: str,
    silver_root: str,
    state_path: str,
    *,
    as_of: AsOf | None = None,
    names: PayloadNames = DEFAULT_NAMES,
    multi_line: bool = False,
    files_per_batch: int = 1000,
    folders: Mapping[str, str] | None = None,
) -> DataFrame:
    """Work off all unread ``store``, ``reviews`` or ``player_stats`` files; one row of counts.

    ``files_per_batch`` bounds the work of a micro-batch and does not change the tables. A run that
    broke off is taken up by the next one, also if no new file has landed. ``processed`` counts the
    items (for players, the rows) of the unread files. ``state_path`` belongs to one ``silver_root``.
    """
    stamp = run_stamp() if as_of is None else as_of
    state = f"{state_path.rstrip('/')}/{kind}"
    payload = {"store": store_core_ddl(names), "reviews": REVIEWS_CORE_DDL, "player_stats": PLAYERS_DDL}[kind]
    documents = (
        spark.readStream.schema(document_schema(payload).add("date", "string"))
        .option("columnNameOfCorruptRecord", UNREADABLE)
        .option("multiLine", str(multi_line).lower())
        .option("maxFilesPerTrigger", files_per_batch)
        .json(landing_path(bronze_root, kind, folders))
        .select("*", F.col("_metadata.file_path").alias(FILE))
    )
    total = dict.fromkeys(COUNTS, 0)

    def add(row: Mapping[str, int]) -> None:
        for name, value in row.items():
            total[name] += value

    def append(batch: DataFrame, _: int) -> None:
        with scratch(batch.sparkSession):
            add(take_in(batch.sparkSession, kind, landed_rows(batch), silver_root, stamp, names).first().asDict())

    def put_aside(batch: DataFrame, number: int) -> None:
        with scratch(batch.sparkSession):
            landed = cut(landed_rows(batch))
            add({"rejected": reject(landed, kind, silver_root, stamp, names)})
            rows = item_records(landed, names) if kind == "store" else summary_records(landed)
            # a repeated micro-batch overwrites its own rows
            tables.replace(newest_records(rows), f"{state}-read", version=number)

    (
        documents.writeStream.foreachBatch(append if kind == "player_stats" else put_aside)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    if kind != "player_stats":
        with scratch(spark):
            add(_fold_in(spark, kind, state, silver_root, stamp))
    return spark.createDataFrame([tuple(total[c] for c in COUNTS)], ", ".join(f"{c} bigint" for c in COUNTS))


def _fold_in(spark: SparkSession, kind: str, state: str, silver_root: str, stamp: AsOf) -> dict[str, int]:
    """Merge the rows put aside since the last fold.

    ``<state>-newest`` holds the newest record per item, its version being the last micro-batch in it.
    It is written after the merge; a merge repeated after a failure between the two finds all unchanged.
    """
    folded = tables.newest_version(spark, f"{state}-newest")
    waiting = tables.finished_versions(spark, f"{state}-read", -1 if folded is None else folded)
    if not waiting:
        return {}
    rows = spark.read.parquet(*(f"{state}-read/v={n}" for n in waiting))
    read = cut(newest_records(rows).withColumn("_read", F.lit(True)))
    known = read
    if folded is not None:
        earlier = tables.read_replaced(spark, f"{state}-newest", folded)
        touched = read.select("app_id", "_read")
        known = read.unionByName(earlier.join(touched, "app_id", "left"))
    # items that no unread file names stay out of the merge
    newest = cut(newest_records(known))
    dim = ITEMS if kind == "store" else REVIEWS
    source = newest.filter("_read").drop("_read", "_record_id")
    counts = merge_dimension(spark, source, dim, KINDS[kind].path(silver_root), stamp).first().asDict()
    tables.replace(newest.drop("_read"), f"{state}-newest", version=waiting[-1])
    return counts
