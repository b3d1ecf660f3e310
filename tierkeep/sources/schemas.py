"""Declared schemas. Every read uses one, so a folder of failures only still has all columns.

Payload field names that carry a vendor's name are parameters (``PayloadNames``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class PayloadNames:
    """Vendor-specific field names inside landed payloads."""

    item_id: str = "item_id"
    author_id: str = "author_id"
    verified_purchase: str = "verified_purchase"


DEFAULT_NAMES = PayloadNames()

# Record states, priorities, and the field layouts of files and tables.
STATUS_SUCCESS, STATUS_FAILED, STATUS_PARTIAL = "success", "failed", "partial"
PRIORITIES = ("high", "medium", "low", "skip")
PIPELINE_VERSION = "0.1.0"

METADATA_DDL = """
    record_id string, batch_id string, source string, source_endpoint string,
    ingested_at string, api_response_time_ms double, status string, error_message string,
    request_params struct<app_id: int>, environment string, pipeline_version string
"""

STATISTICS_DDL = "total_requested bigint, total_success bigint, total_failed bigint, success_rate double"


def store_ddl(names: PayloadNames = DEFAULT_NAMES) -> str:
    return f"""
        type string, name string, `{names.item_id}` int, required_age string, is_free boolean,
        detailed_description string, about_the_game string, short_description string,
        supported_languages string, header_image string, website string,
        developers array<string>, publishers array<string>,
        price_overview struct<currency: string, initial: int, final: int, discount_percent: int,
                              initial_formatted: string, final_formatted: string>,
        platforms struct<windows: boolean, mac: boolean, linux: boolean>,
        metacritic struct<score: int, url: string>,
        categories array<struct<id: int, description: string>>,
        genres array<struct<id: string, description: string>>,
        screenshots array<struct<id: int, path_thumbnail: string, path_full: string>>,
        release_date struct<coming_soon: boolean, date: string>,
        raw_response string,
        error string
    """


def store_core_ddl(names: PayloadNames = DEFAULT_NAMES) -> str:
    """The store fields the item dimension uses; the JSON reader skips all others."""
    return f"""
        type string, name string, `{names.item_id}` int, is_free boolean, short_description string,
        developers array<string>, publishers array<string>,
        price_overview struct<currency: string, initial: int, final: int, discount_percent: int>,
        platforms struct<windows: boolean, mac: boolean, linux: boolean>,
        metacritic struct<score: int>,
        categories array<struct<description: string>>, genres array<struct<description: string>>,
        release_date struct<coming_soon: boolean, date: string>
    """


REVIEWS_CORE_DDL = """
    query_summary struct<review_score: int, review_score_desc: string,
                         total_positive: int, total_negative: int, total_reviews: int>
"""


def reviews_ddl(names: PayloadNames = DEFAULT_NAMES) -> str:
    return f"""
        success int,
        query_summary struct<num_reviews: int, review_score: int, review_score_desc: string,
                             total_positive: int, total_negative: int, total_reviews: int>,
        reviews array<struct<recommendationid: string,
            author: struct<`{names.author_id}`: string, num_games_owned: int, num_reviews: int,
                           playtime_forever: int, playtime_last_two_weeks: int,
                           playtime_at_review: int, last_played: bigint>,
            language: string, review: string, timestamp_created: bigint, timestamp_updated: bigint,
            voted_up: boolean, votes_up: int, votes_funny: int, weighted_vote_score: string,
            comment_count: int, `{names.verified_purchase}`: boolean, received_for_free: boolean,
            written_during_early_access: boolean>>,
        cursor string,
        raw_response string,
        error string
    """


PLAYERS_DDL = "player_count int, result int, raw_response string, error string"

RAW_HEAD_DDL = """
    record_id string, batch_id string, source string, source_endpoint string, ingested_at timestamp,
    api_response_time_ms double, status string, error_message string, environment string,
    pipeline_version string, app_id int
"""

RAW_DDL = {
    "store": f"""
        {RAW_HEAD_DDL}, name string, type string, is_free boolean, short_description string,
        developers array<string>, publishers array<string>, price_currency string, price_initial int,
        price_final int, price_discount_percent int, platforms_windows boolean, platforms_mac boolean,
        platforms_linux boolean, metacritic_score int, categories array<string>, genres array<string>,
        release_date string, coming_soon boolean, raw_json string, ingestion_date string
    """,
    "reviews": f"""
        {RAW_HEAD_DDL}, total_reviews int, total_positive int, total_negative int, review_score int,
        review_score_desc string, raw_json string, ingestion_date string
    """,
    "player_stats": f"{RAW_HEAD_DDL}, player_count int, raw_json string, ingestion_date string",
}

SCD2_DDL = """
    valid_from timestamp, valid_to timestamp, is_current boolean,
    _created_at timestamp, _updated_at timestamp, _source_batch_id string, _ingested_at timestamp
"""

CATALOG_DDL = """
    app_id int, name string, player_count int, priority string,
    discovered_at timestamp, last_synced_at timestamp
"""

ITEM_DIM_DDL = f"""
    game_sk bigint, app_id int, name string, type string, is_free boolean, short_description string,
    developers array<string>, publishers array<string>, price_currency string,
    price_initial_cents int, price_final_cents int, price_discount_percent int,
    platforms_windows boolean, platforms_mac boolean, platforms_linux boolean, metacritic_score int,
    categories array<string>, genres array<string>, release_date string, coming_soon boolean,
    {SCD2_DDL}
"""

REVIEW_DIM_DDL = f"""
    review_sk bigint, app_id int, total_reviews int, total_positive int, total_negative int,
    positive_ratio double, review_score int, review_score_desc string,
    {SCD2_DDL}
"""

PLAYER_FACT_DDL = """
    app_id int, snapshot_timestamp timestamp, player_count int, _created_at timestamp,
    _source_batch_id string, snapshot_date string
"""

ITEM_METRICS_DDL = """
    app_id int, name string, type string, is_free boolean, price_currency string,
    price_initial_cents int, price_final_cents int, price_discount_percent int, price_usd double,
    is_on_sale boolean, genres string, categories string, developers string, publishers string,
    platforms_windows boolean, platforms_mac boolean, platforms_linux boolean, metacritic_score int,
    total_reviews int, total_positive int, total_negative int, positive_ratio double,
    review_score int, review_score_desc string, current_players int,
    player_count_updated_at timestamp, release_date string, coming_soon boolean,
    _refreshed_at timestamp, popularity_score double
"""

PRICE_HISTORY_DDL = """
    app_id int, name string, price_effective_from timestamp, price_effective_to timestamp,
    is_current boolean, price_currency string, price_initial_cents int, price_final_cents int,
    price_discount_percent int, price_initial_usd double, price_final_usd double,
    discount_amount_usd double, is_discounted boolean, discount_tier string, genres string,
    _refreshed_at timestamp, effective_date string
"""

GENRE_SUMMARY_DDL = """
    genre string, game_count bigint, free_games_count bigint, avg_price_usd double,
    min_price_usd double, max_price_usd double, avg_discount_percent double,
    games_on_sale_count bigint, total_reviews bigint, avg_positive_ratio double,
    avg_review_score double, avg_metacritic_score double, games_with_metacritic bigint,
    total_current_players bigint, avg_players_per_game double, max_players_single_game int,
    percent_free double, percent_on_sale double, _refreshed_at timestamp
"""


def struct_of(ddl: str) -> StructType:
    return StructType.fromDDL(" ".join(ddl.split()))


def batch_schema(payload_ddl: str) -> StructType:
    """One landed document: a batch header and its records."""
    record = f"struct<metadata: {struct_of(METADATA_DDL).simpleString()}, raw_data: {struct_of(payload_ddl).simpleString()}>"
    return struct_of(
        f"""batch_id string, source string, started_at string, completed_at string,
            statistics {struct_of(STATISTICS_DDL).simpleString()}, records array<{record}>"""
    )
