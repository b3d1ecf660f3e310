"""What the physical plans must and must not hold, for every query and for the main operators."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tierkeep.operators.scd2 import as_of_join, history_from_snapshots
from tierkeep.plans import gold
from tierkeep.queries import QUERIES
from tierkeep.queries.bindings import observations
from tierkeep.queries.registry import table


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def ranks_all_rows(plan: str) -> bool:
    """A window specification that begins with its order has no partition."""
    firsts = [m.group(1) for m in re.finditer(r"windowspecdefinition\(([^,]*)", plan)]
    return any(f.endswith(("ASC NULLS FIRST", "DESC NULLS LAST")) for f in firsts)


def test_no_query_pairs_rows_runs_python_or_ranks_in_one_task(spark, sf_dir):
    for name, build in QUERIES.items():
        plan = plan_of(build(spark, sf_dir))
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name
        assert "PythonUDF" not in plan and "EvalPython" not in plan, name
        assert not ranks_all_rows(plan), name


def test_the_check_finds_a_global_rank(spark):
    ranked = spark.range(9).withColumn("n", F.row_number().over(Window.orderBy("id")))
    assert ranks_all_rows(plan_of(ranked))


def test_scans_read_only_needed_columns(spark, sf_dir):
    plan = plan_of(QUERIES["scd2_history"](spark, sf_dir))
    scan = re.search(r"ReadSchema: struct<([^>]*)", plan).group(1)
    assert "l_extendedprice" not in scan and "l_comment" not in scan
    cards = plan_of(QUERIES["group_summary"](spark, sf_dir))
    assert "p_brand" not in re.search(r"ReadSchema: struct<([^>]*)", cards).group(1)


def test_filters_reach_the_scan(spark, sf_dir):
    assert "GreaterThanOrEqual(o_orderdate" in plan_of(QUERIES["star_metrics"](spark, sf_dir))
    assert "EqualTo(o_orderstatus" not in plan_of(QUERIES["conditional_update"](spark, sf_dir))
    assert "Not(EqualTo(event_type,error))" in plan_of(QUERIES["status_filter"](spark, sf_dir))


def test_daily_history_shuffles_twice(spark, sf_dir):
    plan = plan_of(history_from_snapshots(observations(spark, sf_dir), "app_id", "day", ["discount_percent"]))
    assert plan.count("Exchange hashpartitioning") == 2


def test_sliced_history_scans_its_snapshots_once(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    plan = plan_of(history_from_snapshots(events, "user_id", "ts", ["event_type"], "day"))
    assert "events.parquet" not in plan, "the snapshots are read again after they were cut down"


def test_as_of_join_never_pairs_facts_with_versions(spark):
    facts = spark.range(10).select(F.col("id").alias("k"), F.timestamp_seconds("id").alias("t"))
    history = facts.select("k", F.col("t").alias("valid_from"), F.timestamp_seconds(F.lit(99)).alias("valid_to"))
    crowded = facts.union(facts.select("k", F.timestamp_seconds(F.col("k") + 9).alias("t")))
    for rows, part_rows, others in ((facts, 1_000_000, 0), (crowded, 1, 2)):
        plan = plan_of(as_of_join(rows, history, "k", "t", part_rows=part_rows))
        joins = re.findall(r"(?:SortMerge|BroadcastHash|ShuffledHash)Join[^\n]*", plan)
        assert sum("FullOuter" in j for j in joins) == 1, "only the summaries of buckets are joined"
        assert all("_key" in j and "_bucket" in j for j in joins)
        assert len(joins) == 1 + others, "the others tell crowded buckets, where there are any"


def test_distinct_count_shuffles_on_group_and_item(spark):
    rows = spark.range(10).select(
        F.col("id").cast("int").alias("app_id"), F.array(F.lit("hot")).alias("genres"), F.lit(False).alias("is_free"),
        *[F.lit(1).alias(c) for c in ("price_final_cents", "price_discount_percent", "metacritic_score", "total_reviews", "review_score", "current_players")],
        F.lit(0.5).alias("positive_ratio"),
    )
    plan = plan_of(gold.group_summary(rows, F.col("genres"), "2024-01-01"))
    assert re.search(r"hashpartitioning\(genre#\w+, app_id#\w+", plan)


@pytest.mark.parametrize("name", ["scd2_history", "latest_per_key", "batch_stats", "group_summary", "star_metrics"])
def test_work_stays_in_generated_code(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    df.collect()
    assert "*(" in plan_of(df)
