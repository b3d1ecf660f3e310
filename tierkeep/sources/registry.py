"""The tables of the three tiers: names, schemas, partitioning, retention."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tierkeep.sources import schemas as s


@dataclass(frozen=True)
class TableSpec:
    name: str
    tier: str
    ddl: str
    partition_by: tuple[str, ...] = ()
    source: str | None = None
    base_path: str = "Tables"
    retention_days: int | None = None  # None keeps everything

    def path(self, root: str) -> str:
        return f"{root.rstrip('/')}/{self.base_path}/{self.name}"


RAW_TABLES = {
    kind: TableSpec(f"raw_{kind}", "bronze", ddl, ("ingestion_date",), source=f"{kind}_api")
    for kind, ddl in s.RAW_DDL.items()
}

CATALOG = TableSpec("game_catalog", "bronze", s.CATALOG_DDL)
ITEM_DIM = TableSpec("dim_games", "silver", s.ITEM_DIM_DDL, ("is_current",))
REVIEW_DIM = TableSpec("dim_game_reviews", "silver", s.REVIEW_DIM_DDL, ("is_current",))
PLAYER_FACT = TableSpec("fact_player_counts", "silver", s.PLAYER_FACT_DDL, ("snapshot_date",))
ITEM_METRICS = TableSpec("agg_game_metrics", "gold", s.ITEM_METRICS_DDL)
PRICE_HISTORY = TableSpec("agg_price_history", "gold", s.PRICE_HISTORY_DDL, ("is_current",))
GENRE_SUMMARY = TableSpec("agg_genre_summary", "gold", s.GENRE_SUMMARY_DDL)

ALL_TABLES = (
    *RAW_TABLES.values(),
    CATALOG,
    ITEM_DIM,
    REVIEW_DIM,
    PLAYER_FACT,
    ITEM_METRICS,
    PRICE_HISTORY,
    GENRE_SUMMARY,
)


def empty_table(spark: SparkSession, spec: TableSpec) -> DataFrame:
    return spark.createDataFrame([], s.struct_of(spec.ddl))
