"""Answers of the sources to landed records: contracts, defaults, payloads of failures, statistics."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import functions as F

from tierkeep.operators.envelope import unwrapped
from tierkeep.plans import bronze
from tierkeep.plans.silver import landing_path
from tierkeep.sources.batches import read_batches
from tierkeep.sources.schemas import PLAYERS_DDL, store_ddl

AT = datetime(2024, 1, 1, 10)
ITEM = {"item_id": 1, "name": "One", "type": "game"}


def answers(spark, texts):
    rows = [(n, AT, "r", t if t is None or isinstance(t, str) else json.dumps(t)) for n, t in texts.items()]
    return spark.createDataFrame(rows, "app_id int, ingested_at timestamp, run string, response string")


def landed(spark, tmp_path, kind, texts, size=100):
    made = bronze.land(spark, answers(spark, texts), kind, str(tmp_path), "run", size)
    documents = spark.read.json(landing_path(str(tmp_path), kind))
    return made, documents


def test_store_answers(spark, tmp_path):
    texts = {
        1: {"1": {"success": True, "data": ITEM}},
        2: {"2": {"success": False}},
        3: {"3": {"success": True, "data": {"item_id": 3, "type": "game"}}},
        4: None,
        5: "no json",
    }
    made, documents = landed(spark, tmp_path, "store", texts, size=2)
    assert sorted(documents.select(F.size("records")).toPandas().iloc[:, 0]) == [1, 2, 2]
    row = made.statistics.first()
    assert (row["successful"], row["failed"], row["operations"], row["status"]) == (1, 4, 5, "partial")
    errors = {r["app_id"]: r["error"] for r in made.errors.collect()}
    assert errors[3] == "contract: name_required" and "success=false" in errors[2] and set(errors) == {2, 3, 4, 5}
    records = read_batches(spark, landing_path(str(tmp_path), "store"), store_ddl())
    rows = {r["request_params"]["app_id"]: r["raw_data"] for r in records.collect()}
    # the contract's defaults are landed, and the message of a failure is its payload
    assert rows[1]["is_free"] is False and rows[1]["developers"] == [] and rows[1]["short_description"] == ""
    assert rows[3]["error"] == errors[3] and rows[3]["name"] is None and rows[1]["error"] is None


def test_review_and_player_answers(spark, tmp_path):
    summary = {"total_reviews": 3, "total_positive": 2, "total_negative": 1, "review_score": 5}
    texts = {
        1: {"success": 1, "query_summary": summary},
        2: {"success": 1, "query_summary": {**summary, "total_negative": -1}},
        3: {"success": 2},
    }
    made, _ = landed(spark, tmp_path, "reviews", texts)
    errors = {r["app_id"]: r["error"] for r in made.errors.collect()}
    assert errors == {2: "contract: total_negative_min", 3: "reviews answered success=0"}
    made, _ = landed(spark, tmp_path, "player_stats", {1: {"player_count": 5, "result": 1}, 2: {"player_count": -5, "result": 1}, 3: {"result": 42}, 4: {"result": 1}})
    errors = {r["app_id"]: r["error"] for r in made.errors.collect()}
    assert errors == {
        2: "contract: player_count_min", 3: "players answered another result", 4: "contract: player_count_required",
    }
    records = read_batches(spark, landing_path(str(tmp_path), "player_stats"), PLAYERS_DDL)
    assert records.filter("status = 'success'").select("raw_data.player_count").first()[0] == 5


def test_no_answers(spark, tmp_path):
    made = bronze.land(spark, answers(spark, {}), "player_stats", str(tmp_path), "run")
    assert made.statistics.first()["operations"] == 0 and made.errors.count() == 0


def test_answers_are_parsed_once(spark):
    rows = unwrapped(answers(spark, {1: "{}"}), F.col("response"), F.col("app_id"), store_ddl())
    used = rows.filter("_ok").filter(F.col("_data.name").isNotNull()).select("_ok", "_data.name", "_data.type")
    records = bronze.store_records(answers(spark, {1: "{}"}).withColumn("_batch", F.lit("b")))
    for frame in (used, records, records.filter("metadata.status = 'failed'")):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 1, plan
