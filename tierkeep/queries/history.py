"""Version history, point-in-time and merge queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierkeep.functions.measures import step_label
from tierkeep.functions.texts import change_hash
from tierkeep.operators.envelope import batched
from tierkeep.operators.keys import assign_chunks, dense_index
from tierkeep.operators.latest import latest_per_key
from tierkeep.operators.scd2 import Dimension, as_of, as_of_join, classify, history_from_snapshots, merge, undated
from tierkeep.operators.updates import update_matched, update_where
from tierkeep.plans.gold import price_statistics
from tierkeep.plans.health import version_census
from tierkeep.queries.bindings import HISTORY_SQL, OBSERVATIONS_SQL, day_string, discount_history, half_up_avg, observations
from tierkeep.queries.registry import query, table
from tierkeep.session import cut

DISCOUNT = Dimension(key="app_id", tracked=("discount_percent",), surrogate="item_sk")


@query(
    "scd2_history",
    f"""{HISTORY_SQL}
select app_id, discount_percent, cast(valid_from as varchar) valid_from, cast(valid_to as varchar) valid_to,
       is_current from hist""",
)
def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discount_history(spark, sf_dir).withColumns(
        {"valid_from": day_string("valid_from"), "valid_to": day_string("valid_to")}
    )


@query(
    "scd2_history_timestamps",
    """
with chg as (select user_id, ts, event_type, lag(event_type) over (partition by user_id order by ts) pe,
                    row_number() over (partition by user_id order by ts) n from events),
ver as (select * from chg where n = 1 or event_type is distinct from pe)
select user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') valid_from,
       coalesce(strftime(lead(ts) over (partition by user_id order by ts), '%Y-%m-%d %H:%M:%S.%f'),
                '9999-12-31 23:59:59.000000') valid_to,
       lead(ts) over (partition by user_id order by ts) is null is_current from ver""",
)
def scd2_history_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions at event times: a user's rows are spread over days, so no user is one task's work."""
    events = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    history = history_from_snapshots(events, "user_id", "ts", ["event_type"], slice_by="day")
    text = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return history.select(
        "user_id",
        "event_type",
        F.date_format("valid_from", text).alias("valid_from"),
        F.date_format("valid_to", text).alias("valid_to"),
        "is_current",
    )


_TIED_SQL = """with o as (select user_id, event_id, event_type,
                  case when event_id % 50 <> 0 then date_trunc('day', ts) end t from events)"""


@query(
    "scd2_history_ties",
    f"""{_TIED_SQL},
last as (select * from o where t is not null
         qualify row_number() over (partition by user_id, t order by event_id desc, event_type desc) = 1),
ver as (select * from last qualify row_number() over (partition by user_id order by t) = 1
        or event_type is distinct from lag(event_type) over (partition by user_id order by t))
select user_id, event_id, event_type, strftime(t, '%Y-%m-%d') valid_from,
       coalesce(strftime(lead(t) over (partition by user_id order by t), '%Y-%m-%d'), '9999-12-31') valid_to from ver""",
)
def scd2_history_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions where many rows of a user share a time and some have none: the last event of a moment counts."""
    tied = _tied_events(spark, sf_dir)
    history = history_from_snapshots(tied, "user_id", "t", ["event_type"], ties=["event_id"])
    return history.select(
        "user_id", "event_id", "event_type", day_string("valid_from").alias("valid_from"), day_string("valid_to").alias("valid_to")
    )


@query("scd2_history_undated", f"{_TIED_SQL} select user_id, event_id, event_type from o where t is null or user_id is null")
def scd2_history_undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the history above leaves out."""
    return undated(_tied_events(spark, sf_dir), "user_id", "t").drop("t")


def _tied_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_trunc("day", F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(
        "user_id", "event_id", "event_type", F.when(F.col("event_id") % 50 != 0, day).alias("t")
    )


@query(
    "scd2_as_of",
    f"""{HISTORY_SQL}
select app_id, discount_percent from hist where valid_from <= date '1998-06-30' and date '1998-06-30' < valid_to""",
)
def scd2_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_of(discount_history(spark, sf_dir), "1998-06-30").select("app_id", "discount_percent")


@query(
    "current_versions",
    f"{HISTORY_SQL} select app_id, discount_percent, cast(valid_from as varchar) valid_from from hist where is_current",
)
def current_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = discount_history(spark, sf_dir)
    return history.filter("is_current").select("app_id", "discount_percent", day_string("valid_from").alias("valid_from"))


@query(
    "discount_tier",
    f"""{HISTORY_SQL}
select app_id, cast(valid_from as varchar) valid_from,
       case when discount_percent = 0 then 'No Discount' when discount_percent < 3 then 'Small'
            when discount_percent < 6 then 'Medium' when discount_percent < 9 then 'Large' else 'Huge' end tier
from hist""",
)
def discount_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = ((3, "Small"), (6, "Medium"), (9, "Large"))
    tier = step_label(F.col("discount_percent"), "No Discount", steps, "Huge")
    return discount_history(spark, sf_dir).select("app_id", day_string("valid_from").alias("valid_from"), tier.alias("tier"))


def _two_states(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Last discount per part before July 1995 and from then on."""
    observed = observations(spark, sf_dir)
    old = observed.filter(F.col("day") < "1995-07-01")
    new = observed.filter(F.col("day") >= "1995-07-01")
    return latest_per_key(old, ["app_id"], [F.desc("day")]), latest_per_key(new, ["app_id"], [F.desc("day")])


_TWO_STATES_SQL = f"""with {OBSERVATIONS_SQL},
a as (select k, disc from (select *, row_number() over (partition by k order by d desc) r from obs
                           where d < date '1995-07-01') x where r = 1),
b as (select k, disc from (select *, row_number() over (partition by k order by d desc) r from obs
                           where d >= date '1995-07-01') x where r = 1)"""


@query(
    "scd2_classify",
    f"""{_TWO_STATES_SQL}
select b.k app_id, b.disc discount_percent,
       case when a.k is null then 'new' when a.disc is distinct from b.disc then 'changed' else 'unchanged' end status
from b left join a on a.k = b.k""",
)
def scd2_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _two_states(spark, sf_dir)
    return classify(new, old, DISCOUNT).select("app_id", "discount_percent", F.col("_status").alias("status"))


@query(
    "scd2_classify_counts",
    f"""{_TWO_STATES_SQL}
select case when a.k is null then 'new'
            when md5(coalesce(cast(a.disc as varchar), '__NULL__')) <> md5(coalesce(cast(b.disc as varchar), '__NULL__'))
            then 'changed' else 'unchanged' end status, count(*) n
from b left join a on a.k = b.k group by 1""",
)
def scd2_classify_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _two_states(spark, sf_dir)
    by_hash = Dimension(DISCOUNT.key, DISCOUNT.tracked, DISCOUNT.surrogate, by_hash=True)
    tagged = classify(new, old, by_hash).withColumnRenamed("_status", "status")
    return tagged.groupBy("status").agg(F.count("*").alias("n"))


@query(
    "change_hash",
    """select p_partkey, md5(coalesce(cast(p_size as varchar), '__NULL__') || '||' || coalesce(p_brand, '__NULL__')
       || '||' || coalesce(p_type, '__NULL__')) row_hash from part""",
)
def change_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    return parts.select("p_partkey", change_hash([F.col("p_size"), F.col("p_brand"), F.col("p_type")]).alias("row_hash"))


MERGE_DAYS = ("1996-12-31", "1998-12-31", "2002-01-01")


def folded(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Current slice, closed versions and counts after merging three snapshots, one per day."""
    observed = observations(spark, sf_dir)
    current, closed, counts = None, None, []
    for day in MERGE_DAYS:
        snapshot = latest_per_key(observed.filter(F.col("day") <= day), ["app_id"], [F.desc("day")]).drop("day")
        step = merge(snapshot, current, DISCOUNT, day)
        current = step.current
        closed = step.closed if closed is None else closed.unionByName(step.closed)
        counts.append(step.metrics.withColumn("batch", F.lit(day)))
    return current, closed, counts


_SNAPSHOTS_SQL = f"""with {OBSERVATIONS_SQL},
batches(b, day) as (values (1, date '1996-12-31'), (2, date '1998-12-31'), (3, date '2002-01-01')),
snap as (select * from (select b, day, k, disc, row_number() over (partition by b, k order by d desc) r
                        from obs join batches on d <= day) x where r = 1),
st as (select *, case when lag(disc) over w is null then 'new' when lag(disc) over w <> disc then 'changed'
                      else 'unchanged' end status from snap window w as (partition by k order by b))"""


@query(
    "merge_fold",
    f"""{_SNAPSHOTS_SQL},
ver as (select *, row_number() over (order by b, status, k) item_sk from st where status <> 'unchanged')
select cast(item_sk as bigint) item_sk, k app_id, disc discount_percent, cast(day as varchar) valid_from,
       coalesce(cast(lead(day) over (partition by k order by b) as varchar), '9999-12-31') valid_to,
       lead(day) over (partition by k order by b) is null is_current from ver""",
)
def merge_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three merges in a row give dense surrogate keys and abutting versions."""
    current, closed, _ = folded(spark, sf_dir)
    return current.unionByName(closed).select(
        "item_sk",
        "app_id",
        "discount_percent",
        day_string("valid_from").alias("valid_from"),
        day_string("valid_to").alias("valid_to"),
        "is_current",
    )


@query(
    "merge_metrics",
    f"""{_SNAPSHOTS_SQL}
select cast(day as varchar) batch, count(*) processed, count(*) filter (where status = 'new') inserted,
       count(*) filter (where status = 'changed') updated, count(*) filter (where status = 'unchanged') unchanged
from st group by 1""",
)
def merge_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, (first, second, third) = folded(spark, sf_dir)
    return first.unionByName(second).unionByName(third)


@query(
    "price_series",
    f"""{HISTORY_SQL}
select app_id, count(*) points, min(discount_percent) lowest, max(discount_percent) highest,
       {half_up_avg("discount_percent", 4)} average from hist group by app_id""",
)
def price_series_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_statistics(discount_history(spark, sf_dir), "discount_percent")


@query("dim_census", f"{HISTORY_SQL} select is_current, count(*) versions from hist group by is_current")
def dim_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    return version_census(discount_history(spark, sf_dir))


@query(
    "fact_dim_as_of",
    f"""{HISTORY_SQL}
select f.l_orderkey, f.l_linenumber, h.discount_percent from lineitem f
join orders o on o.o_orderkey = f.l_orderkey
join hist h on h.app_id = f.l_partkey and h.valid_from <= cast(o.o_orderdate as date)
     and cast(o.o_orderdate as date) < h.valid_to""",
)
def fact_dim_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The discount a part had when each of its order lines was ordered."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("date").alias("ordered")
    )
    # looked at twice, so kept as a dimension would be
    history = cut(discount_history(spark, sf_dir)).withColumnRenamed("app_id", "l_partkey")
    facts = lines.join(orders, "l_orderkey")
    wanted = ("l_orderkey", "l_linenumber"), ("discount_percent",)
    return as_of_join(facts, history, "l_partkey", "ordered", fact_columns=wanted[0], version_columns=wanted[1])


@query(
    "surrogate_keys",
    """select p_partkey, cast(100 + row_number() over (order by p_brand, p_partkey) as bigint) item_sk from part""",
)
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return dense_index(parts, [F.col("p_brand"), F.col("p_partkey")], "item_sk", start=101).drop("p_brand")


@query(
    "chunk_assign",
    "select p_partkey, cast(floor((row_number() over (order by p_partkey) - 1) / 100) as bigint) chunk from part",
)
def chunk_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_chunks(table(spark, sf_dir, "part").select("p_partkey"), [F.col("p_partkey")])


@query(
    "batch_assign",
    """select o_orderkey, concat(o_orderpriority, '-', cast((row_number() over (order by o_orderpriority, o_orderkey) - 1) // 100
       as varchar)) batch from orders""",
)
def batch_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of at most 100 orders of one priority."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    rows = batched(orders, [F.col("o_orderkey")], "o_orderpriority")
    return rows.select("o_orderkey", F.col("_batch").alias("batch"))


@query(
    "matched_update",
    """select c.c_custkey, c.c_name, case when u.k is not null then u.spent else cast(c.c_acctbal as double) end c_acctbal
       from customer c left join (select o_custkey k, max(o_totalprice) spent from orders
                                  where o_orderdate >= timestamp '2000-01-01' group by 1) u on u.k = c.c_custkey""",
)
def matched_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers take the value of their largest recent order; others keep theirs."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    recent = table(spark, sf_dir, "orders").filter(F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz"))
    updates = recent.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("c_acctbal"))
    return update_matched(customers, updates, "c_custkey", ["c_acctbal"])


@query(
    "conditional_update",
    """select o_orderkey, case when o_orderstatus = 'P' and o_totalprice < 100000 then 'F' else o_orderstatus end o_orderstatus,
       case when o_orderstatus = 'P' and o_totalprice < 100000 then 'closed' else o_orderpriority end o_orderpriority
       from orders""",
)
def conditional_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    small_pending = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") < 100000)
    changes = {"o_orderpriority": F.lit("closed"), "o_orderstatus": F.lit("F")}
    return update_where(orders, small_pending, changes).drop("o_totalprice")
