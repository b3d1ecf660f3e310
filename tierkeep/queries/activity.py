"""Queries over raw events: latest rows, batches, ratios, appends, refresh decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierkeep.functions.measures import count_where, safe_ratio
from tierkeep.functions.times import weekday_index
from tierkeep.operators.envelope import batch_statistics
from tierkeep.operators.facts import append_counts, known, unseen
from tierkeep.operators.latest import latest_partition, latest_per_key
from tierkeep.plans.catalog import (
    REFRESH_WEEKDAYS,
    build_catalog,
    catalog_statistics,
    discover_new,
    entries_to_sync,
    mark_synced,
    priority_changes,
    priority_distribution,
    priority_of,
    refresh_priorities,
    refreshed_catalog,
    run_discovery,
    run_refresh,
    scheduled,
    sync_estimates,
    typed_catalog,
)
from tierkeep.plans.gold import top_items
from tierkeep.queries.bindings import ACTIVITY_SQL, LIMITS, PRIORITY_SQL, activity, day_string
from tierkeep.queries.registry import query, table
from tierkeep.session import scratch_path


@query(
    "latest_per_key",
    """select user_id, event_id, event_type from (select *, row_number() over (partition by user_id
       order by ts desc, event_id desc) rn from events) x where rn = 1""",
)
def latest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    newest = latest_per_key(events, ["user_id"], [F.desc("ts"), F.desc("event_id")])
    return newest.select("user_id", "event_id", "event_type")


@query(
    "latest_partition",
    """select user_id, max(event_id) event_id from events
       where cast(ts as date) = (select max(cast(ts as date)) from events) group by user_id""",
)
def latest_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of every user seen on the newest day."""
    events = table(spark, sf_dir, "events")
    newest = latest_partition(events, F.col("ts").cast("date"), ["user_id"], [F.desc("event_id")])
    return newest.select("user_id", "event_id")


@query(
    "status_filter",
    """select event_id, user_id, strftime(ts, '%Y-%m-%d') as "day" from events where event_type <> 'error'""",
)
def status_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").filter(F.col("event_type") != "error")
    return events.select("event_id", "user_id", day_string("ts").alias("day"))


@query(
    "positive_ratio",
    f"""with {ACTIVITY_SQL}
select user_id, n, case when n > 0 then cast(purchases as double) / n end positive_ratio from act""",
)
def positive_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = activity(spark, sf_dir)
    return users.select("user_id", "n", safe_ratio(F.col("purchases"), F.col("n")).alias("positive_ratio"))


@query(
    "batch_stats",
    """select strftime(ts, '%Y-%m-%d') batch, count(*) total_requested,
       count(*) filter (where event_type <> 'error') total_success,
       count(*) filter (where event_type = 'error') total_failed,
       count(*) filter (where event_type <> 'error') / cast(count(*) as double) * 100 success_rate
       from events group by 1""",
)
def batch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("batch", day_string("ts"))
    return batch_statistics(events, ["batch"], F.col("event_type") != "error")


@query(
    "json_extract",
    "select event_id, cast(json_extract_string(props, '$.k') as int) k from events",
)
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select("event_id", F.from_json("props", "k int").getField("k").alias("k"))


@query(
    "batch_anti_append",
    """with stored as (select distinct cast(ts as date) d from events where cast(ts as date) <= date '2024-01-20')
select event_id from events e where not exists (select 1 from stored where stored.d = cast(e.ts as date))""",
)
def batch_anti_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only batches (days) not stored yet."""
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("date").alias("batch"))
    return unseen(events, events.filter(F.col("batch") <= "2024-01-20"), "batch").select("event_id")


@query(
    "append_metrics",
    """select count(*) processed, count(*) filter (where cast(ts as date) > date '2024-01-20') inserted,
       cast(0 as bigint) updated, count(*) filter (where cast(ts as date) <= date '2024-01-20') unchanged from events""",
)
def append_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("batch"))
    return append_counts(events, events.filter(F.col("batch") <= "2024-01-20"), "batch")


@query("distinct_batches", "select distinct strftime(ts, '%Y-%m-%d') batch from events")
def distinct_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(day_string("ts").alias("batch")).distinct()


@query(
    "weekday_counts",
    """select strftime(ts, '%Y-%m-%d') as "day", cast(isodow(ts) - 1 as int) weekday, count(*) n from events group by 1, 2""",
)
def weekday_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.groupBy(
        F.date_format("ts", "yyyy-MM-dd").alias("day"), weekday_index(F.col("ts")).alias("weekday")
    ).agg(F.count("*").alias("n"))


@query(
    "top_n",
    "select user_id, n from (select user_id, count(*) n from events group by user_id) x order by n desc, user_id limit 10",
)
def top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"))
    return top_items(counts, "n", 10, tie="user_id")


@query("priority_classify", f"with {PRIORITY_SQL} select user_id, n, priority from pr")
def priority_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity(spark, sf_dir).select("user_id", "n", priority_of(F.col("n"), limits=LIMITS).alias("priority"))


@query("priority_counts", f"with {PRIORITY_SQL} select priority, count(*) n from pr group by priority")
def priority_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return priority_classify(spark, sf_dir).groupBy("priority").agg(F.count("*").alias("n"))


@query(
    "semi_join_filter",
    f"with {PRIORITY_SQL} select event_id from events where user_id in (select user_id from pr where priority = 'high')",
)
def semi_join_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of high-priority users: the IN list is a table and stays one."""
    wanted = priority_classify(spark, sf_dir).filter("priority = 'high'")
    return known(table(spark, sf_dir, "events"), wanted, "user_id").select("event_id")


def _user_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog of users, last synced at their last event."""
    return activity(spark, sf_dir).select(
        F.col("user_id").alias("app_id"),
        F.col("n").alias("player_count"),
        priority_of(F.col("n"), limits=LIMITS).alias("priority"),
        F.col("last_ts").cast("timestamp").alias("last_synced_at"),
    )


@query(
    "stale_selection",
    f"""with {PRIORITY_SQL}
select user_id app_id, priority from pr
where (priority = 'high' and last_ts < timestamp '2024-01-30 12:00:00')
   or (priority = 'medium' and last_ts < timestamp '2024-01-30 00:00:00')
   or (priority = 'low' and last_ts < timestamp '2024-01-29 00:00:00')""",
)
def stale_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On Sunday, 4 February 2024 all priorities are due; limits are days before that noon."""
    limits = {"high": 5.0, "medium": 5.5, "low": 6.5}
    due = entries_to_sync(_user_catalog(spark, sf_dir), "2024-02-04 12:00:00", limit_days=limits)
    return due.select("app_id", "priority")


@query(
    "schedule_by_day",
    f"""with {PRIORITY_SQL},
days as (select distinct cast(ts as date) d from events)
select strftime(d, '%Y-%m-%d') as "day", priority, isodow(d) in (6, 7, 1) and priority = 'medium' or priority = 'high'
       or isodow(d) = 7 and priority = 'low' due
from days, (select distinct priority from pr) p""",
)
def schedule_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which priorities are due on each day with events."""
    days = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("d")).distinct()
    names = F.array(*[F.lit(name) for name in REFRESH_WEEKDAYS])
    present = priority_classify(spark, sf_dir).select("priority").distinct()
    pairs = days.withColumn("priority", F.explode(names)).join(present, "priority", "left_semi")
    return pairs.select(F.date_format("d", "yyyy-MM-dd").alias("day"), "priority", scheduled(F.col("priority"), F.col("d")).alias("due"))


@query(
    "catalog_rows",
    f"""with {PRIORITY_SQL}
select cast(user_id as int) app_id, cast(n as int) player_count, priority, strftime(last_ts, '%Y-%m-%d %H:%M:%S') discovered,
       cast(null as varchar) "name" from pr""",
)
def catalog_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog rows whose times come as ISO text, brought to the declared types."""
    users = activity(spark, sf_dir).select(
        F.col("user_id").alias("app_id"),
        F.col("n").alias("player_count"),
        priority_of(F.col("n"), limits=LIMITS).alias("priority"),
        F.date_format("last_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("discovered_at"),
    )
    typed = typed_catalog(users)
    return typed.select(
        "app_id", "player_count", "priority", F.date_format("discovered_at", "yyyy-MM-dd HH:mm:ss").alias("discovered"), "name"
    )


_HALVES_SQL = """with a as (select user_id, count(*) n from events where ts < timestamp '2024-01-30' group by 1),
b as (select user_id, count(*) n from events where ts >= timestamp '2024-01-30' group by 1),
m as (select a.user_id, a.n old_n, coalesce(b.n, a.n) new_n from a left join b on a.user_id = b.user_id),
c as (select *, case when old_n >= 70 then 'high' when old_n >= 3 then 'medium' when old_n >= 1 then 'low' else 'skip' end old_priority,
             case when new_n >= 70 then 'high' when new_n >= 3 then 'medium' when new_n >= 1 then 'low' else 'skip' end new_priority from m)"""


def _refreshed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A catalog from all days but the last, and the same with the last day's counts put in."""
    limits = (("high", 70), ("medium", 3), ("low", 1))
    events = table(spark, sf_dir, "events")
    last_day = F.col("ts") >= F.lit("2024-01-30").cast("timestamp_ntz")

    def counts(part: DataFrame) -> DataFrame:
        return part.groupBy(F.col("user_id").alias("app_id")).agg(F.count("*").alias("player_count"))

    catalog = counts(events.filter(~last_day)).withColumn("priority", priority_of(F.col("player_count"), "skip", limits))
    return catalog, refresh_priorities(catalog, counts(events.filter(last_day)), limits)


@query("priority_refresh", f"{_HALVES_SQL} select user_id app_id, new_n player_count, new_priority priority from c")
def priority_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed(spark, sf_dir)[1]


@query(
    "priority_changes",
    f"{_HALVES_SQL} select user_id app_id, old_priority, new_priority from c where old_priority <> new_priority",
)
def changed_priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return priority_changes(*_refreshed(spark, sf_dir))


def _part_catalog(spark: SparkSession, sf_dir: str, stamp: str = "2024-01-01") -> DataFrame:
    """A catalog of parts with the lines that shipped since 2001 as activity."""
    return build_catalog(*_part_entries(spark, sf_dir), stamp, words=("ring", "bolt"), limits=_PART_LIMITS)


_PART_LIMITS = (("high", 8), ("medium", 4), ("low", 1))


def _part_entries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    entries = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("app_id"), F.col("p_name").alias("name"))
    recent = table(spark, sf_dir, "lineitem").filter(F.col("l_shipdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    counts = recent.groupBy(F.col("l_partkey").alias("app_id")).agg(F.count("*").alias("player_count"))
    return entries, counts


_PART_CATALOG_SQL = """
cnt as (select l_partkey k, count(*) n from lineitem where l_shipdate >= timestamp '2001-01-01' group by 1),
cat as (select p_partkey app_id, p_name as "name", n player_count,
               case when n is null then 'low' when n >= 8 then 'high' when n >= 4 then 'medium' when n >= 1 then 'low'
                    else 'skip' end priority
        from part left join cnt on k = p_partkey where not (lower(p_name) like '%ring%' or lower(p_name) like '%bolt%'))"""


@query(
    "catalog_build",
    f"""with {_PART_CATALOG_SQL}
select *, '2024-01-01' discovered_at, cast(null as varchar) last_synced_at from cat""",
)
def catalog_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword exclusion, activity join and priorities in one plan."""
    return _part_catalog(spark, sf_dir).withColumns(
        {
            "discovered_at": F.date_format("discovered_at", "yyyy-MM-dd"),
            "last_synced_at": F.date_format("last_synced_at", "yyyy-MM-dd"),
        }
    )


def _catalog_before_2001(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A catalog holding the parts shipped before 1995-07, and what discovery sees later."""
    entries, counts = _part_entries(spark, sf_dir)
    early = table(spark, sf_dir, "lineitem").filter(F.col("l_shipdate") < F.lit("1995-07-01").cast("timestamp_ntz"))
    listed = known(entries, early.select(F.col("l_partkey").alias("app_id")), "app_id")
    options = {"words": ("ring", "bolt"), "limits": _PART_LIMITS}
    return build_catalog(listed, counts, "1995-07-01", **options), entries, counts


_EARLY_SQL = "early as (select distinct l_partkey k from lineitem where l_shipdate < timestamp '1995-07-01')"


@query(
    "catalog_discover",
    f"with {_PART_CATALOG_SQL}, {_EARLY_SQL} select app_id, priority from cat where app_id not in (select k from early)",
)
def catalog_discover(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog, entries, counts = _catalog_before_2001(spark, sf_dir)
    found = discover_new(catalog, entries, counts, "2024-01-01", words=("ring", "bolt"), limits=_PART_LIMITS)
    return found.select("app_id", "priority")


@query(
    "catalog_refresh",
    f"""with {_PART_CATALOG_SQL}, {_EARLY_SQL}
select app_id, priority, case when app_id in (select k from early) then '1995-07-01' else '2024-01-01' end discovered_at
from cat""",
)
def catalog_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog, entries, counts = _catalog_before_2001(spark, sf_dir)
    grown = refreshed_catalog(catalog, entries, counts, "2024-01-01", words=("ring", "bolt"), limits=_PART_LIMITS)
    return grown.select("app_id", "priority", F.date_format("discovered_at", "yyyy-MM-dd").alias("discovered_at"))


@query(
    "catalog_cycle",
    f"""with {_EARLY_SQL},
games as (select p_partkey from part where not regexp_matches(lower(p_name),
  'soundtrack|ost| dlc|dlc |pack|bundle|demo|beta test|dedicated server|sdk|tool|editor|art book|wallpaper|bonus content|pre-order|preorder|season pass|expansion pass|supporter|upgrade'))
select count(*) filter (where k is not null) previous_count, count(*) filter (where k is null) new_games_added,
       count(*) final_count from games left join early on k = p_partkey""",
)
def catalog_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored catalog of the early parts, refreshed with all parts: counts before, added and after."""
    entries, counts = _part_entries(spark, sf_dir)
    early = table(spark, sf_dir, "lineitem").filter(F.col("l_shipdate") < F.lit("1995-07-01").cast("timestamp_ntz"))
    listed = known(entries, early.select(F.col("l_partkey").alias("app_id")), "app_id")
    root = scratch_path(spark, "catalog")
    run_discovery(spark, root, listed, counts, "1995-07-01")
    return run_refresh(spark, root, entries, counts, "2024-01-01")


@query(
    "mark_synced",
    f"""with {PRIORITY_SQL}
select user_id app_id, priority, case when priority = 'high' then '2024-02-01' else strftime(last_ts, '%Y-%m-%d') end last_synced
from pr""",
)
def synced(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = _user_catalog(spark, sf_dir)
    stamped = mark_synced(catalog, catalog.filter("priority = 'high'"), "2024-02-01")
    return stamped.select("app_id", "priority", F.date_format("last_synced_at", "yyyy-MM-dd").alias("last_synced"))


@query(
    "catalog_stats",
    f"""with {PRIORITY_SQL}
select count(*) total, count(*) filter (where priority = 'high') high, count(*) filter (where priority = 'medium') medium,
       count(*) filter (where priority = 'low') low, count(*) filter (where priority = 'skip') skip,
       count(*) filter (where n > 0) with_players, cast(sum(n) as bigint) total_players from pr""",
)
def statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog_statistics(_user_catalog(spark, sf_dir))


@query(
    "priority_distribution",
    f"""with {PRIORITY_SQL}
select priority, count(*) games, cast(sum(n) as bigint) total_players, avg(n) avg_players from pr group by priority""",
)
def distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return priority_distribution(_user_catalog(spark, sf_dir))


@query(
    "sync_estimates",
    f"""with {PRIORITY_SQL},
e as (select 'high' scope, count(*) filter (where priority = 'high') entries from pr
      union all select 'high+medium', count(*) filter (where priority in ('high', 'medium')) from pr
      union all select 'all', count(*) filter (where priority in ('high', 'medium', 'low')) from pr)
select scope, entries, entries * 3 total_requests, round(entries * 3 / 10.0, 1)::double estimated_seconds,
       round(entries * 3 / 10.0 / 60, 1)::double estimated_minutes, round(entries * 3 / 10.0 / 3600, 2)::double estimated_hours
from e""",
)
def estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sync_estimates(_user_catalog(spark, sf_dir))


@query(
    "new_keys",
    """select distinct o_custkey from orders o where o_orderdate >= timestamp '1996-01-01'
       and not exists (select 1 from orders p where p.o_custkey = o.o_custkey and p.o_orderdate < timestamp '1996-01-01')""",
)
def new_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers who first ordered in or after 1996."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    cut_off = F.lit("1996-01-01").cast("timestamp_ntz")
    # one row per customer before the join, so a customer with most of the orders is no hot key
    later = orders.filter(F.col("o_orderdate") >= cut_off).select("o_custkey").distinct()
    return unseen(later, orders.filter(F.col("o_orderdate") < cut_off), "o_custkey")


@query(
    "contract_counts_by_status",
    """select o_orderstatus, count(*) requested, count(*) filter (where o_totalprice > 250000) large from orders group by 1""",
)
def conditional_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy("o_orderstatus").agg(
        F.count("*").alias("requested"), count_where(F.col("o_totalprice") > 250000).alias("large")
    )
