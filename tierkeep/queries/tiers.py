"""The three tiers built from the supplied tables: landed batches, two silver runs, gold products."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierkeep.functions.texts import joined
from tierkeep.plans.gold import (
    genre_summary,
    item_metrics,
    kpi_cards,
    latest_players,
    price_history,
    price_series,
    price_statistics,
    run_gold,
    shares,
    stored_latest_players,
    top_items,
)
from tierkeep.plans.health import table_health, version_census
from tierkeep.plans.silver import landing_path, run_silver, run_totals
from tierkeep.queries.bindings import day_string, half_up_avg, half_up_percent
from tierkeep.queries.landing import PLAYERS_SQL, REVIEWS_SQL, STORE_SQL, player_records, review_records, store_records
from tierkeep.queries.registry import query
from tierkeep.session import cut, scratch, scratch_path
from tierkeep.sources import registry, tables
from tierkeep.sources.batches import write_batches
from tierkeep.streaming.ingest import ingest_new

FIRST_RUN, SECOND_RUN = "1998-12-31", "2002-01-01"
_built: dict[tuple[str, str], tuple[str, DataFrame]] = {}


def silver_tiers(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """(folder, results of the second run), built once per session and data folder.

    The first run sees the store years up to 1998 and the days up to 15 January; the second
    run finds the rest landed as well.
    """
    known = (spark.sparkContext.applicationId, sf_dir)
    if known in _built:
        return _built[known]
    root = scratch_path(spark, "tiers")
    first_part = {"store": F.col("run") <= 1998, "reviews": F.col("run") <= "2024-01-15", "player_stats": F.col("run") <= "2024-01-15"}
    with scratch(spark):
        records = {
            "store": store_records(spark, sf_dir),
            "reviews": review_records(spark, sf_dir),
            "player_stats": player_records(spark, sf_dir),
        }
        for stamp, first in ((FIRST_RUN, True), (SECOND_RUN, False)):
            for kind, rows in records.items():
                part = first_part[kind] if first else ~first_part[kind]
                with scratch(spark):
                    write_batches(cut(rows.filter(part)), landing_path(root, kind), compression="gzip")
            results = run_silver(spark, root, root, as_of=stamp)
    _built[known] = (root, results)
    return _built[known]


def _items(spark: SparkSession, root: str) -> DataFrame:
    return tables.read_current(spark, registry.ITEM_DIM.path(root))


def _item_history(spark: SparkSession, root: str) -> DataFrame:
    return tables.read_history(spark, registry.ITEM_DIM.path(root))


def _gold_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    root, _ = silver_tiers(spark, sf_dir)
    reviews = tables.read_current(spark, registry.REVIEW_DIM.path(root))
    return _items(spark, root), reviews, stored_latest_players(spark, root)


DIM_SQL = f"""{STORE_SQL},
ok as (select *, case when is_free then null else pct end disc, case when not is_free then cents * (100 - pct) // 100 end final,
              case when not is_free then cents end initial from st where ok),
l1 as (select * from (select *, row_number() over (partition by p_partkey order by shipped desc, batch desc) n from ok where run <= 1998) x where n = 1),
l2 as (select * from (select *, row_number() over (partition by p_partkey order by shipped desc, batch desc) n from ok) x where n = 1),
cmp as (select l2.p_partkey k, case when l1.p_partkey is null then 'new'
               when l1.final is distinct from l2.final or l1.disc is distinct from l2.disc or l1.score is distinct from l2.score
               then 'changed' else 'unchanged' end status from l2 left join l1 on l1.p_partkey = l2.p_partkey),
dim as (select l1.*, '1998-12-31' vf, case when status = 'changed' then '2002-01-01' else '9999-12-31' end vt, status <> 'changed' cur, 0 grp
        from l1 join cmp on k = p_partkey
        union all select l2.*, '2002-01-01', '9999-12-31', true, case when status = 'changed' then 1 else 2 end from l2 join cmp on k = p_partkey
        where status <> 'unchanged'),
dims as (select *, row_number() over (order by grp, p_partkey) sk from dim)"""

REVIEW_DIM_SQL = f"""{REVIEWS_SQL},
rr as (select *, pos + neg total, pos / cast(pos + neg as double) ratio, (pos + neg) % 10 score,
              case when pos > neg then 'Positive' else 'Mixed' end descr from re where pos + neg > 0),
r1 as (select * from (select *, row_number() over (partition by user_id order by run desc) n from rr where run <= '2024-01-15') x where n = 1),
r2 as (select * from (select *, row_number() over (partition by user_id order by run desc) n from rr) x where n = 1),
rc as (select r2.user_id k, case when r1.user_id is null then 'new'
              when r1.total <> r2.total or r1.ratio <> r2.ratio or r1.score <> r2.score then 'changed' else 'unchanged' end status
       from r2 left join r1 on r1.user_id = r2.user_id),
rd as (select r1.* from r1 join rc on k = user_id where status = 'unchanged'
       union all select r2.* from r2 join rc on k = user_id where status <> 'unchanged')"""

LATEST_PLAYERS_SQL = f"""{PLAYERS_SQL},
pok as (select * from pl where n > signups),
pd as (select * from pok where run = (select max(run) from pok))"""

STAR_SQL = f"""with {DIM_SQL}, {REVIEW_DIM_SQL}, {LATEST_PLAYERS_SQL},
star as (select d.*, rd.total, rd.pos, rd.neg, rd.ratio, rd.score rscore, rd.descr, pd.n players, pd.run seen
         from dims d left join rd on rd.user_id = d.p_partkey left join pd on pd.user_id = d.p_partkey where cur)"""


_ITEM_SQL = """cast(p_partkey as int) app_id, p_name "name", 'game' "type", is_free, p_brand || ' ' || p_type short_description,
       p_brand developers, p_brand || ', ' || p_type publishers, case when not is_free then 'USD' end price_currency,
       initial price_initial_cents, final price_final_cents, disc price_discount_percent, p_size % 2 = 0 platforms_windows,
       p_size % 3 = 0 platforms_mac, p_size % 5 = 0 platforms_linux, score metacritic_score, p_type categories,
       replace(p_name, ' ', ', ') genres, strftime(shipped, '%b %-d, %Y') release_date, coming_soon,
       batch _source_batch_id, strftime(shipped, '%Y-%m-%d') _ingested_at"""


def _item_rows(history: DataFrame) -> DataFrame:
    """All columns of the item dimension, arrays as text and times as days."""
    lists = ("developers", "publishers", "categories", "genres")
    times = ("valid_from", "valid_to", "_created_at", "_updated_at", "_ingested_at")
    return history.withColumns({**{c: joined(F.col(c)) for c in lists}, **{c: day_string(c) for c in times}})


@query(
    "silver_items",
    f"""with {DIM_SQL}
select cast(sk as bigint) game_sk, {_ITEM_SQL}, vf valid_from, vt valid_to, cur is_current, vf _created_at,
       case when cur then vf else vt end _updated_at from dims""",
)
def silver_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The item dimension after two runs, all versions."""
    return _item_rows(_item_history(spark, silver_tiers(spark, sf_dir)[0]))


@query(
    "incremental_items",
    f"""with {DIM_SQL}
select row_number() over (order by p_partkey) game_sk, {_ITEM_SQL}, '2002-01-01' valid_from, '9999-12-31' valid_to,
       true is_current, '2002-01-01' _created_at, '2002-01-01' _updated_at from l2""",
)
def incremental_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The item dimension filled by the file stream, 20 files at a time, run twice: the second run finds nothing new."""
    landed, _ = silver_tiers(spark, sf_dir)
    silver, state = scratch_path(spark, "streamed"), scratch_path(spark, "stream-state")
    for _ in range(2):
        ingest_new(spark, "store", landed, silver, state, as_of=SECOND_RUN, files_per_batch=20)
    return _item_rows(_item_history(spark, silver))


@query(
    "silver_reviews",
    f"""with {REVIEW_DIM_SQL}
select cast(user_id as int) app_id, cast(total as int) total_reviews, cast(pos as int) total_positive,
       cast(neg as int) total_negative, ratio positive_ratio, cast(score as int) review_score, descr review_score_desc from rd""",
)
def silver_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = silver_tiers(spark, sf_dir)
    return tables.read_current(spark, registry.REVIEW_DIM.path(root)).select(
        "app_id", "total_reviews", "total_positive", "total_negative", "positive_ratio", "review_score", "review_score_desc"
    )


@query(
    "silver_players",
    f"""with {PLAYERS_SQL}
select cast(user_id as int) app_id, cast(n as int) player_count, run snapshot_date,
       case when run <= '2024-01-15' then '1998-12-31' else '2002-01-01' end created from pl where n > signups""",
)
def silver_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The player fact: the second run reads all batches and adds only unseen ones."""
    root, _ = silver_tiers(spark, sf_dir)
    fact = tables.read(spark, registry.PLAYER_FACT.path(root), registry.PLAYER_FACT.ddl)
    return fact.select("app_id", "player_count", "snapshot_date", day_string("_created_at").alias("created"))


_RUN_SQL = f"""with {DIM_SQL}, {REVIEW_DIM_SQL}, {PLAYERS_SQL},
m as (select 'dim_games' table_name, status from cmp union all select 'dim_game_reviews', status from rc
      union all select 'fact_player_counts', case when run <= '2024-01-15' then 'unchanged' else 'new' end from pl where n > signups),
res as (select table_name, count(*) processed, count(*) filter (where status = 'new') inserted,
               count(*) filter (where status = 'changed') updated, count(*) filter (where status = 'unchanged') unchanged
        from m group by 1)"""


@query("silver_run", f"{_RUN_SQL} select *, cast(0 as bigint) rejected, true success, cast(null as varchar) error from res")
def silver_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result rows of the second silver run (durations left out)."""
    return silver_tiers(spark, sf_dir)[1].drop("seconds")


@query(
    "silver_run_totals",
    f"""{_RUN_SQL} select cast(sum(processed) as bigint) total_processed, cast(sum(inserted) as bigint) total_inserted,
       cast(sum(updated) as bigint) total_updated, cast(sum(unchanged) as bigint) total_unchanged,
       cast(0 as bigint) total_rejected, true all_successful from res""",
)
def silver_run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_totals(silver_tiers(spark, sf_dir)[1]).drop("seconds")


@query("silver_census", f"with {DIM_SQL} select cur is_current, count(*) versions from dims group by cur")
def silver_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    return version_census(_item_history(spark, silver_tiers(spark, sf_dir)[0]))


@query(
    "latest_players",
    f"""with {LATEST_PLAYERS_SQL}
select cast(user_id as int) app_id, cast(n as int) player_count, run snapshot_date from pd""",
)
def newest_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the newest day, found by a scalar subquery over the fact."""
    root, _ = silver_tiers(spark, sf_dir)
    fact = tables.read(spark, registry.PLAYER_FACT.path(root), registry.PLAYER_FACT.ddl)
    return latest_players(fact).select("app_id", "player_count", "snapshot_date")


@query(
    "newest_folder_players",
    f"""with {LATEST_PLAYERS_SQL}
select cast(user_id as int) app_id, cast(n as int) player_count, run snapshot_date from pd""",
)
def newest_folder_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, opening only the newest day's folder."""
    return _gold_parts(spark, sf_dir)[2].select("app_id", "player_count", "snapshot_date")


@query(
    "incremental_players",
    f"""with {PLAYERS_SQL}
select cast(user_id as int) app_id, cast(n as int) player_count, run snapshot_date from pl where n > signups""",
)
def incremental_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The player fact filled by the file stream, run twice: the second run finds nothing new."""
    landed, _ = silver_tiers(spark, sf_dir)
    silver, state = scratch_path(spark, "streamed"), scratch_path(spark, "stream-state")
    for _ in range(2):
        ingest_new(spark, "player_stats", landed, silver, state, as_of=SECOND_RUN)
    fact = tables.read(spark, registry.PLAYER_FACT.path(silver), registry.PLAYER_FACT.ddl)
    return fact.select("app_id", "player_count", "snapshot_date")


def gold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return item_metrics(*_gold_parts(spark, sf_dir), SECOND_RUN)


_METRICS_SQL = f"""{STAR_SQL},
gm as (select cast(p_partkey as int) app_id, p_name "name", 'game' "type", is_free, case when not is_free then 'USD' end price_currency,
       initial price_initial_cents, final price_final_cents, disc price_discount_percent, final / 100 price_usd,
       coalesce(disc > 0, false) is_on_sale, replace(p_name, ' ', ', ') genres, p_type categories, p_brand developers,
       p_brand || ', ' || p_type publishers, p_size % 2 = 0 platforms_windows, p_size % 3 = 0 platforms_mac,
       p_size % 5 = 0 platforms_linux, score metacritic_score, cast(total as int) total_reviews, cast(pos as int) total_positive,
       cast(neg as int) total_negative, ratio positive_ratio, cast(rscore as int) review_score, descr review_score_desc,
       cast(players as int) current_players, seen player_count_updated_at, strftime(shipped, '%b %-d, %Y') release_date,
       coming_soon, '2002-01-01' _refreshed_at,
       round(ln(1 + coalesce(players, 0)) * coalesce(ratio, 0.5) * 100, 2) popularity_score from star)"""


@query("item_metrics", f"{_METRICS_SQL} select * from gm")
def gold_item_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 30-column item table."""
    return gold_metrics(spark, sf_dir).withColumns(
        {"player_count_updated_at": day_string("player_count_updated_at"), "_refreshed_at": day_string("_refreshed_at")}
    )


_POINTS_SQL = f"""with {DIM_SQL},
ph as (select cast(p_partkey as int) app_id, p_name "name", vf price_effective_from, vt price_effective_to, cur is_current,
       case when not is_free then 'USD' end price_currency, initial price_initial_cents, final price_final_cents,
       disc price_discount_percent, initial / 100 price_initial_usd, final / 100 price_final_usd,
       (initial - final) / 100 discount_amount_usd, coalesce(disc > 0, false) is_discounted,
       case when disc is null then 'Huge (75%+)' when disc = 0 then 'No Discount' when disc < 25 then 'Small (1-24%)'
            when disc < 50 then 'Medium (25-49%)' when disc < 75 then 'Large (50-74%)' else 'Huge (75%+)' end discount_tier,
       replace(p_name, ' ', ', ') genres, '2002-01-01' _refreshed_at, vf effective_date from dims)"""


def gold_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_history(_item_history(spark, silver_tiers(spark, sf_dir)[0]), SECOND_RUN)


@query("price_history", f"{_POINTS_SQL} select * from ph")
def gold_price_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 17-column price history; free items have no price block and land in the top tier."""
    days = {d: day_string(d) for d in ("price_effective_from", "price_effective_to", "_refreshed_at")}
    return gold_points(spark, sf_dir).withColumns(days)


_SUMMARY_SQL = f"""{STAR_SQL},
x as (select *, unnest(string_split(p_name, ' ')) genre from star),
gs as (select genre, count(distinct p_partkey) game_count, count(*) filter (where is_free) free_games_count,
       {half_up_avg("case when not is_free then final end", 2, 100)} avg_price_usd,
       round(min(case when not is_free then final end) / 100, 2) min_price_usd,
       round(max(case when not is_free then final end) / 100, 2) max_price_usd,
       {half_up_avg("disc")} avg_discount_percent, count(*) filter (where disc > 0) games_on_sale_count,
       cast(sum(total) as bigint) total_reviews, round(avg(ratio), 4) avg_positive_ratio, {half_up_avg("rscore")} avg_review_score,
       {half_up_avg("score")} avg_metacritic_score, count(score) games_with_metacritic, cast(sum(players) as bigint) total_current_players,
       {half_up_avg("players", 0)} avg_players_per_game, cast(max(players) as int) max_players_single_game from x group by genre)"""


def gold_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genre_summary(*_gold_parts(spark, sf_dir), SECOND_RUN)


@query(
    "genre_summary",
    f"""{_SUMMARY_SQL} select *, {half_up_percent("free_games_count", "game_count")} percent_free,
       {half_up_percent("games_on_sale_count", "game_count")} percent_on_sale, '2002-01-01' _refreshed_at from gs""",
)
def gold_genre_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 19-column genre table."""
    return gold_genres(spark, sf_dir).withColumn("_refreshed_at", day_string("_refreshed_at"))


@query(
    "players_by_genre",
    f"""{_SUMMARY_SQL} select genre, total_current_players, {half_up_percent("total_current_players",
       "select sum(total_current_players) from gs")} share_percent from gs""",
)
def players_by_genre(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shares(gold_genres(spark, sf_dir), "genre", "total_current_players")


@query(
    "top_popular",
    f"""{_METRICS_SQL} select app_id, "name", price_usd, current_players, positive_ratio, popularity_score from gm
order by popularity_score desc, app_id limit 10""",
)
def top_popular(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten items with the highest popularity."""
    columns = ["app_id", "name", "price_usd", "current_players", "positive_ratio", "popularity_score"]
    return top_items(gold_metrics(spark, sf_dir).select(*columns), "popularity_score", 10)


@query(
    "top_played",
    f"""{_METRICS_SQL} select app_id, "name", current_players from gm order by current_players desc nulls last, app_id limit 20""",
)
def top_played(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_items(gold_metrics(spark, sf_dir).select("app_id", "name", "current_players"), "current_players", 20)


@query(
    "overview_cards",
    f"""{_METRICS_SQL}
select count(*) total_games, cast(sum(current_players) as bigint) total_players,
       {half_up_avg("case when not is_free then price_final_cents end", 2, 100)} avg_price_usd,
       {half_up_percent("count(*) filter (where is_on_sale)", "count(*)")} on_sale_percent,
       round(avg(positive_ratio), 4) avg_rating from gm""",
)
def overview_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi_cards(gold_metrics(spark, sf_dir))


@query(
    "item_price_series",
    f"""{_POINTS_SQL} select "name", price_final_usd, discount_tier, price_effective_from, is_current from ph
where app_id = (select app_id from ph group by app_id order by count(*) desc, app_id limit 1)""",
)
def item_price_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The price points of the item with most of them."""
    points = gold_points(spark, sf_dir)
    most = top_items(price_statistics(points), "points", 1).select("app_id").scalar()
    return price_series(points, most).withColumn("price_effective_from", day_string("price_effective_from"))


@query(
    "price_statistics",
    f"""{_POINTS_SQL} select app_id, count(*) points, min(price_final_cents) lowest, max(price_final_cents) highest,
       {half_up_avg("price_final_cents", 4)} average from ph group by app_id""",
)
def item_price_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_statistics(gold_points(spark, sf_dir))


@query(
    "gold_run",
    f"""{_SUMMARY_SQL}
select 'agg_game_metrics' table_name, count(*) filter (where cur) records, true success, cast(null as varchar) error from dims
union all select 'agg_price_history', count(*), true, null from dims
union all select 'agg_genre_summary', count(*), true, null from gs""",
)
def gold_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result rows of a gold run (durations left out)."""
    root, _ = silver_tiers(spark, sf_dir)
    return run_gold(spark, root, scratch_path(spark, "gold"), as_of=SECOND_RUN).drop("seconds")


@query(
    "tier_health",
    f"""with {DIM_SQL}, {PLAYERS_SQL}
select 'dim_games' table_name, count(*) records, true success, cast(null as varchar) error from dims
union all select 'fact_player_counts', count(*), true, null from pl where n > signups""",
)
def tier_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = silver_tiers(spark, sf_dir)
    openers = {
        registry.ITEM_DIM.name: lambda: _item_history(spark, root),
        registry.PLAYER_FACT.name: lambda: tables.read(spark, registry.PLAYER_FACT.path(root), registry.PLAYER_FACT.ddl),
    }
    return table_health(spark, openers)


@query(
    "schema_merging_append",
    """select p_partkey, p_name, case when p_size > 25 then p_brand end p_brand from part""",
)
def schema_merging_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends, the second with one more column; the first's rows read NULL there."""
    path = scratch_path(spark, "appended")
    parts = spark.read.parquet(f"{sf_dir.rstrip('/')}/part.parquet")
    tables.append(parts.filter("p_size <= 25").select("p_partkey", "p_name"), path)
    tables.append(parts.filter("p_size > 25").select("p_partkey", "p_name", "p_brand"), path)
    return tables.read(spark, path, merge_schema=True)


@query(
    "partitioned_append",
    """select o_orderkey, strftime(o_orderdate, '%Y') order_year from orders""",
)
def partitioned_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stored by year and read back."""
    path = scratch_path(spark, "partitioned")
    orders = spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet")
    rows = orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy").alias("order_year"))
    tables.append(rows, path, ["order_year"])
    return tables.read(spark, path, "o_orderkey bigint, order_year string")


@query(
    "full_refresh",
    "select c_custkey, c_mktsegment from customer",
)
def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced by one with other columns: readers see the newest finished version."""
    path = scratch_path(spark, "replaced")
    customers = spark.read.parquet(f"{sf_dir.rstrip('/')}/customer.parquet")
    tables.replace(customers.select("c_custkey", "c_name"), path)
    tables.replace(customers.select("c_custkey", "c_mktsegment"), path)
    return tables.read_replaced(spark, path)
