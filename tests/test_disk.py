"""What landing, silver, gold and the stream leave on disk: compressed documents, and no kept tables."""

from __future__ import annotations

import gzip
import json
import re
from datetime import datetime
from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from tests import landing as documents
from tierkeep.operators import envelope as e
from tierkeep.plans import gold, silver
from tierkeep.queries import landing, tiers
from tierkeep.session import cut, shared_folder
from tierkeep.sources import batches
from tierkeep.sources.schemas import PLAYERS_DDL
from tierkeep.streaming.ingest import ingest_new


@pytest.fixture
def left_over(spark):
    """Tables kept below the shared folder since the test began."""
    folder = Path(urlparse(shared_folder(spark)).path)
    before = {p.name for p in folder.glob("kept-*")}
    return lambda: sorted(p.name for p in folder.glob("kept-*") if p.name not in before)


@pytest.fixture
def few_tables(spark, tmp_path):
    """Three parts with a line in either of two years, and the events of two users on two days."""
    day = datetime
    lines = [(p, 10 * p + y, 1, 0.05, "N", "O", day(y, 3, p)) for p in (1, 2, 3) for y in (1998, 1999)]
    names = "l_partkey bigint, l_orderkey bigint, l_linenumber int, l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    spark.createDataFrame(lines, names).write.parquet(f"{tmp_path}/lineitem.parquet")
    parts = [(p, f"red part{p}", "Brand#1", "PROMO" if p == 3 else "ECONOMY", 10 * p, 9.5 + p) for p in (1, 2, 3)]
    names = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    spark.createDataFrame(parts, names).write.parquet(f"{tmp_path}/part.parquet")
    seen = [(u, kind, day(2024, 1, d, 1)) for u in (1, 2) for d in (2, 20) for kind in ("purchase", "error", "view")]
    spark.createDataFrame(seen, "user_id bigint, event_type string, ts timestamp_ntz").write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def files(path):
    return sorted(p for p in Path(urlparse(path).path).rglob("*.json*") if not p.name.startswith("."))


def test_landed_queries_keep_only_compressed_documents(spark, few_tables, left_over, monkeypatch):
    paths = []
    monkeypatch.setattr(landing, "scratch_path", lambda *a: paths.append(few_tables + f"/out{len(paths)}") or paths[-1])
    assert landing.envelope(spark, few_tables).count() == 6
    assert sum(r["total_success"] for r in landing.landed_batch_stats(spark, few_tables).collect()) == 6
    assert {r["app_id"]: r["_source_batch_id"] for r in landing.typed_store(spark, few_tables).collect()} == dict.fromkeys((1, 2, 3), "1999-0")
    assert len(paths) == 3 and all(f.name.endswith(".json.gz") for p in paths for f in files(p)) and files(paths[0])
    assert left_over() == []


def test_tiers_keep_only_their_tables(spark, few_tables, left_over):
    root, results = tiers.silver_tiers(spark, few_tables)
    assert {r["table_name"]: (r["processed"], r["inserted"]) for r in results.collect()} == {
        "dim_games": (3, 0), "dim_game_reviews": (2, 0), "fact_player_counts": (4, 2),
    }
    landed = files(f"{root}/Files/bronze")
    assert landed and all(f.name.endswith(".json.gz") for f in landed)
    assert left_over() == []
    assert tiers.incremental_items(spark, few_tables).count() == 3
    assert tiers.incremental_players(spark, few_tables).count() == 4
    assert {r["table_name"]: r["records"] for r in tiers.gold_run(spark, few_tables).collect()}["agg_game_metrics"] == 3
    assert left_over() == []


def test_silver_gold_and_stream_delete_what_they_kept(spark, tmp_path, left_over):
    root, state = str(tmp_path), f"{tmp_path}/state"
    documents.first_day(root)
    assert all(r["success"] for r in silver.run_silver(spark, root, root, as_of="2024-01-01 20:00:00").collect())
    assert all(r["success"] for r in gold.run_gold(spark, root, root, as_of="2024-01-01 21:00:00").collect())
    for kind in ("store", "reviews", "player_stats"):
        assert ingest_new(spark, kind, root, f"{root}/streamed", state, as_of="2024-01-01 20:00:00").first()["inserted"] > 0
    assert left_over() == []


def _records(spark, rows):
    frame = spark.createDataFrame(rows, "app_id int, at timestamp, batch string")
    payload = F.struct(F.col("app_id").alias("player_count"), F.lit(1).alias("result"))
    made = e.stamped(
        frame.withColumn("raw_data", payload), key="app_id", batch=F.col("batch"), source=F.lit("player_stats_api"),
        endpoint=F.lit("players"), ingested_at=F.col("at"), succeeded=F.lit(True), error=F.lit(None),
    )
    return made.select("metadata", "raw_data")


@pytest.mark.parametrize("task_records", [2, 50_000])
def test_batches_are_whole_whatever_their_names_times_and_tasks(spark, tmp_path, monkeypatch, task_records):
    """Batches over midnight, without name, without time, and a day over several tasks; repeated rows stay."""
    monkeypatch.setattr(batches, "TASK_RECORDS", task_records)
    night = [(i, datetime(2024, 1, 1 + i % 2, 12), "night") for i in range(4)]
    rows = night + [(i, datetime(2024, 1, 3, 1), None) for i in (5, 5, 6)] + [(7, None, "timeless"), (None, None, None)]
    rows += [(i, datetime(2024, 1, 4, i), f"b{i % 4}") for i in range(12)]
    batches.write_batches(cut(_records(spark, rows)), f"{tmp_path}/raw", compression="gzip")
    found = {}
    for f in files(f"{tmp_path}/raw"):
        for line in gzip.decompress(f.read_bytes()).decode().splitlines():
            d = json.loads(line)
            assert d.get("batch_id") not in found
            items = sorted((r["metadata"]["request_params"].get("app_id") or -1) for r in d["records"])
            found[d.get("batch_id")] = (f.parent.name, d["statistics"]["total_requested"], items)
    null_day = "date=__HIVE_DEFAULT_PARTITION__"
    assert found == {
        "night": ("date=2024-01-01", 4, [-1, 1, 2, 3]), None: ("date=2024-01-03", 4, [-1, 5, 5, 6]), "timeless": (null_day, 1, [7]),
        **{f"b{k}": ("date=2024-01-04", 3, [k or -1, k + 4, k + 8]) for k in range(4)},
    }
    assert batches.read_batches(spark, f"{tmp_path}/raw", PLAYERS_DDL).count() == len(rows)


def test_records_move_once(spark, tmp_path):
    """Whole records are shuffled to the task that gathers and writes them, and not again."""
    records = cut(_records(spark, [(i, datetime(2024, 1, 1 + i % 3), f"b{i % 5}") for i in range(30)]))
    plans = []
    real = batches.batch_documents
    try:
        batches.batch_documents = lambda *a: plans.append(real(*a)) or plans[-1]
        batches.write_batches(records, f"{tmp_path}/raw")
    finally:
        batches.batch_documents = real
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if re.search(r"\bExchange\b", line)]
    assert len(moved) == 1 and "_task" in moved[0], plan
