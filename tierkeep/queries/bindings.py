"""How the supplied tables stand in for an item store.

part = items (words of the name = genres, PROMO = free), lineitem = dated price observations,
events = raw records and activity per user (error = failed), customer with events and orders = star.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierkeep.operators.latest import latest_per_key
from tierkeep.operators.scd2 import history_from_snapshots
from tierkeep.queries.registry import table


def percent(column: str) -> F.Column:
    return F.round(F.col(column) * 100).cast("int")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last observed discount per part and ship day."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("app_id"),
        F.col("l_shipdate").cast("date").alias("day"),
        percent("l_discount").alias("discount_percent"),
        "l_orderkey",
        "l_linenumber",
    )
    newest = [F.desc("l_orderkey"), F.desc("l_linenumber")]
    return latest_per_key(lines, ["app_id", "day"], newest).drop("l_orderkey", "l_linenumber")


OBSERVATIONS_SQL = """
o as (select l_partkey k, cast(l_shipdate as date) d, cast(round(l_discount*100) as int) disc,
             row_number() over (partition by l_partkey, cast(l_shipdate as date)
                                order by l_orderkey desc, l_linenumber desc) rn from lineitem),
obs as (select k, d, disc from o where rn = 1)"""


def discount_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All discount versions per part."""
    return history_from_snapshots(observations(spark, sf_dir), "app_id", "day", ["discount_percent"]).drop("day")


HISTORY_SQL = f"""with {OBSERVATIONS_SQL},
chg as (select k, d, disc, lag(disc) over (partition by k order by d) pd,
               row_number() over (partition by k order by d) n from obs),
ver as (select k, d, disc from chg where n = 1 or disc is distinct from pd),
hist as (select k app_id, disc discount_percent, d valid_from,
                coalesce(lead(d) over (partition by k order by d), date '9999-12-31') valid_to,
                lead(d) over (partition by k order by d) is null is_current from ver)"""


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events, purchases and last event time per user."""
    return table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("event_type") == "purchase").alias("purchases"),
        F.max("ts").alias("last_ts"),
    )


ACTIVITY_SQL = """
act as (select user_id, count(*) n, sum(case when event_type='purchase' then 1 else 0 end) purchases,
               max(ts) last_ts from events group by user_id)"""

# cut-offs fitting the events per user of the supplied tables
LIMITS = (("high", 75), ("medium", 60), ("low", 1))
PRIORITY_SQL = f"""{ACTIVITY_SQL},
pr as (select user_id, n, last_ts, case when n is null then 'low' when n >= 75 then 'high'
              when n >= 60 then 'medium' when n >= 1 then 'low' else 'skip' end priority from act)"""


def day_string(column: str) -> F.Column:
    return F.date_format(F.col(column), "yyyy-MM-dd")


def half_up_avg(x: str, digits: int = 2, divisor: int = 1) -> str:
    """SQL for the average of whole numbers over ``divisor``, rounded half up.

    Written in whole numbers: ``round`` on a double may round 4.975 down, as it is stored below that.
    """
    scale = 10**digits
    return f"(2 * {scale} * sum({x}) + count({x}) * {divisor}) // (2 * {divisor} * count({x})) / cast({scale} as double)"


def half_up_percent(part: str, total: str) -> str:
    """SQL for a percentage of whole numbers with two digits, rounded half up."""
    return f"(20000 * ({part}) + ({total})) // (2 * ({total})) / cast(100 as double)"
