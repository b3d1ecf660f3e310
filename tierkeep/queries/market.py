"""Gold-style queries straight over the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierkeep.functions.measures import cents_to_amount, cents_to_decimal, count_where, is_above, percent_of, popularity, safe_ratio
from tierkeep.functions.texts import digits_or_zero, joined, mentions
from tierkeep.operators.updates import refresh_values
from tierkeep.plans.gold import kpi_cards, shares
from tierkeep.plans.health import table_health, within_retention
from tierkeep.queries.bindings import ACTIVITY_SQL, activity, half_up_avg, half_up_percent, percent
from tierkeep.queries.registry import query, table


@query(
    "star_metrics",
    f"""with {ACTIVITY_SQL},
r as (select user_id, cast(purchases as double) / n positive_ratio from act),
p as (select o_custkey, count(*) recent_orders from orders where o_orderdate >= timestamp '2001-01-01' group by 1)
select c.c_custkey, r.positive_ratio, p.recent_orders,
       round(ln(1 + coalesce(p.recent_orders, 0)) * coalesce(r.positive_ratio, 0.5) * 100, 2) popularity
from customer c left join r on r.user_id = c.c_custkey left join p on p.o_custkey = c.c_custkey""",
)
def star_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their rating and recent orders; both sides are added up before the joins."""
    ratings = activity(spark, sf_dir).select(
        F.col("user_id").alias("c_custkey"), safe_ratio(F.col("purchases"), F.col("n")).alias("positive_ratio")
    )
    recent = table(spark, sf_dir, "orders").filter(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    orders = recent.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("recent_orders"))
    star = table(spark, sf_dir, "customer").select("c_custkey").join(ratings, "c_custkey", "left").join(orders, "c_custkey", "left")
    return star.withColumn("popularity", popularity(F.col("recent_orders"), F.col("positive_ratio")))


_GENRE_SQL = f"""
x as (select p_partkey, unnest(string_split(p_name, ' ')) genre, p_type = 'PROMO' free,
             cast(round(p_retailprice * 100) as bigint) cents, p_size from part),
g as (select genre, count(distinct p_partkey) items, count(*) filter (where free) free_items,
             {half_up_avg("case when not free then cents end", 2, 100)} avg_price,
             round(min(case when not free then cents end) / 100, 2) min_price,
             round(max(case when not free then cents end) / 100, 2) max_price,
             cast(sum(p_size) as bigint) total_size, {half_up_avg("p_size")} avg_size,
             count(*) filter (where p_size > 25) large_items from x group by genre)"""


def _genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.explode_outer(F.split("p_name", " ")).alias("genre"),
        (F.col("p_type") == "PROMO").alias("free"),
        F.round(F.col("p_retailprice") * 100).cast("bigint").alias("cents"),
        "p_size",
    )
    paid = F.when(~F.col("free"), F.col("cents"))
    return parts.withColumn("genre", F.coalesce("genre", F.lit("Unknown"))).groupBy("genre").agg(
        F.countDistinct("p_partkey").alias("items"),
        count_where(F.col("free")).alias("free_items"),
        F.round(cents_to_amount(F.avg(paid)), 2).alias("avg_price"),
        F.round(cents_to_amount(F.min(paid)), 2).alias("min_price"),
        F.round(cents_to_amount(F.max(paid)), 2).alias("max_price"),
        F.sum("p_size").alias("total_size"),
        F.round(F.avg("p_size"), 2).alias("avg_size"),
        count_where(F.col("p_size") > 25).alias("large_items"),
    )


@query(
    "group_summary",
    f"with {_GENRE_SQL} select *, {half_up_percent('free_items', 'items')} percent_free from g",
)
def genre_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _genres(spark, sf_dir).withColumn("percent_free", percent_of(F.col("free_items"), F.col("items")))


@query(
    "group_share",
    f"""with {_GENRE_SQL}
select genre, items, {half_up_percent("items", "select sum(items) from g")} share_percent from g""",
)
def group_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shares(_genres(spark, sf_dir), "genre", "items")


@query(
    "kpi_cards",
    f"""with {ACTIVITY_SQL},
d as (select l_partkey k, max(cast(round(l_discount * 100) as int)) pct from lineitem group by 1)
select count(*) total_games, cast(sum(n) as bigint) total_players,
       {half_up_avg("case when p_type <> 'PROMO' then cast(round(p_retailprice * 100) as bigint) end", 2, 100)} avg_price_usd,
       {half_up_percent("count(*) filter (where pct > 5)", "count(*)")} on_sale_percent,
       round(avg(cast(purchases as double) / n), 4) avg_rating
from part left join act on user_id = p_partkey left join d on k = p_partkey""",
)
def kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    discounts = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("app_id")).agg(F.max(percent("l_discount")).alias("pct"))
    users = activity(spark, sf_dir).select(
        F.col("user_id").alias("app_id"),
        F.col("n").alias("current_players"),
        safe_ratio(F.col("purchases"), F.col("n")).alias("positive_ratio"),
    )
    items = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("app_id"),
        (F.col("p_type") == "PROMO").alias("is_free"),
        F.round(F.col("p_retailprice") * 100).cast("bigint").alias("price_final_cents"),
    )
    metrics = items.join(users, "app_id", "left").join(discounts, "app_id", "left")
    return kpi_cards(metrics.withColumn("is_on_sale", is_above(F.col("pct"), 5)))


@query(
    "keyword_filter",
    "select p_partkey from part where not (lower(p_name) like '%ring%' or lower(p_name) like '%bolt%')",
)
def keyword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    return parts.filter(~mentions(F.col("p_name"), ("ring", "bolt"))).select("p_partkey")


@query(
    "add_on_documents",
    """select doc_id from documents where not regexp_matches(lower(text),
       'soundtrack|ost| dlc|dlc |pack|bundle|demo|beta test|dedicated server|sdk|tool|editor|costume|art book|artbook|wallpaper|bonus content|pre-order|preorder|season pass|expansion pass|supporter|upgrade')""",
)
def add_on_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full word list against whole document texts."""
    return table(spark, sf_dir, "documents").filter(~mentions(F.col("text"))).select("doc_id")


@query(
    "array_text",
    """select p_partkey, replace(p_name, ' ', ', ') genres, coalesce(try_cast(p_type as int), 0) age,
       cast(p_size as int) sized from part""",
)
def array_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays joined to text; digit text becomes a number, other text 0."""
    parts = table(spark, sf_dir, "part")
    return parts.select(
        "p_partkey",
        joined(F.split("p_name", " ")).alias("genres"),
        digits_or_zero(F.col("p_type")).alias("age"),
        digits_or_zero(F.col("p_size").cast("string")).alias("sized"),
    )


@query(
    "price_amounts",
    """select p_partkey, cast(round(p_retailprice * 100) as bigint) / 100 price_usd,
       cast(cast(cast(round(p_retailprice * 100) as bigint) as decimal(18,2)) / 100 as varchar) price_text from part""",
)
def price_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cents as a double and as an exact decimal (shown as text)."""
    cents = F.round(F.col("p_retailprice") * 100).cast("bigint")
    parts = table(spark, sf_dir, "part")
    exact = cents_to_decimal(cents).cast("double").cast("string")
    return parts.select("p_partkey", cents_to_amount(cents).alias("price_usd"), exact.alias("price_text"))


@query(
    "refresh_values",
    """with f as (select l_partkey k, min(l_extendedprice) low from lineitem where l_shipdate >= timestamp '2001-10-01' group by 1)
select p_partkey, coalesce(f.low, p_retailprice) p_retailprice from part left join f on k = p_partkey""",
)
def refreshed_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = table(spark, sf_dir, "lineitem").filter(F.col("l_shipdate") >= F.lit("2001-10-01").cast("timestamp_ntz"))
    fresh = recent.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.min("l_extendedprice").alias("p_retailprice"))
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    return refresh_values(parts, fresh, "p_partkey", "p_retailprice")


TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


@query(
    "table_health",
    " union all ".join(
        f"select '{name}' table_name, count(*) records, true success, cast(null as varchar) error from {name}" for name in TABLES
    ),
)
def health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_health(spark, {name: lambda name=name: table(spark, sf_dir, name) for name in TABLES})


@query(
    "retention",
    """select event_id from events where cast(ts as date) >= date '2024-01-24'""",
)
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the last seven days before 31 January."""
    return within_retention(table(spark, sf_dir, "events"), F.col("ts").cast("date"), "2024-01-31", 7).select("event_id")
