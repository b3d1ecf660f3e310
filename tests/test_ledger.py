"""Batches told by content, landings of their own, versions claimed by one writer."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tierkeep.operators.scd2 import Dimension
from tierkeep.plans import bronze, silver
from tierkeep.plans.silver import landing_path, run_silver
from tierkeep.sources import ledger, registry, tables
from tierkeep.sources.batches import read_batches
from tierkeep.sources.schemas import PLAYERS_DDL, reviews_ddl, store_ddl
from tierkeep.streaming.ingest import ingest_new


def answers(spark, found, hour=10):
    rows = [(k, datetime(2024, 1, 1, hour), "2024-01-01", json.dumps({"player_count": n, "result": 1})) for k, n in found.items()]
    return spark.createDataFrame(rows, "app_id int, ingested_at timestamp, run string, response string")


def fact(spark, root):
    rows = tables.read(spark, registry.PLAYER_FACT.path(root), registry.PLAYER_FACT.ddl).collect()
    return sorted((r["app_id"], r["player_count"]) for r in rows)


def test_two_landings_of_one_run_lose_no_row(spark, tmp_path):
    root = str(tmp_path)
    bronze.land(spark, answers(spark, {1: 10, 2: 20}), "player_stats", root, "run")
    run_silver(spark, root, root, as_of="2024-01-02", include=("players",))
    bronze.land(spark, answers(spark, {3: 30, 4: 40}), "player_stats", root, "run")
    row = run_silver(spark, root, root, as_of="2024-01-03", include=("players",)).first()
    assert (row["processed"], row["inserted"], row["unchanged"], row["rejected"]) == (4, 2, 2, 0)
    assert fact(spark, root) == [(1, 10), (2, 20), (3, 30), (4, 40)]
    again = run_silver(spark, root, root, as_of="2024-01-04", include=("players",)).first()
    assert (again["inserted"], again["unchanged"]) == (0, 4)
    ids = read_batches(spark, landing_path(root, "player_stats"), PLAYERS_DDL).select("batch_id", "record_id").distinct()
    assert ids.select("batch_id").distinct().count() == 2 and ids.count() == 4


@pytest.mark.parametrize("files_per_batch", [1, 1000])
def test_one_name_for_two_batches_and_a_repeated_file(spark, tmp_path, files_per_batch):
    """Two files with one batch id are both stored, the third, a copy of the first, is not: streamed and in full."""
    landed, root, full = str(tmp_path / "landed"), str(tmp_path / "streamed"), str(tmp_path / "full")
    for found in ({1: 10, 2: 20}, {3: 30, 4: 40}, {1: 10, 2: 20}):
        bronze.land(spark, answers(spark, found), "player_stats", landed, "run", landing="same")
    row = ingest_new(
        spark, "player_stats", landed, root, f"{root}/state", as_of="2024-01-02", files_per_batch=files_per_batch
    ).first()
    assert (row["processed"], row["inserted"], row["unchanged"]) == (6, 4, 2)
    run_silver(spark, landed, full, as_of="2024-01-02", include=("players",))
    assert fact(spark, root) == fact(spark, full) == [(1, 10), (2, 20), (3, 30), (4, 40)]


def test_the_fact_is_not_searched(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    bronze.land(spark, answers(spark, {1: 10}), "player_stats", root, "run")
    run_silver(spark, root, root, as_of="2024-01-02", include=("players",))
    seen = []
    monkeypatch.setattr(silver, "unseen", lambda *a: seen.append(a))
    bronze.land(spark, answers(spark, {2: 20}), "player_stats", root, "run")
    assert run_silver(spark, root, root, as_of="2024-01-03", include=("players",)).first()["inserted"] == 1
    assert seen == []


def player_source(spark, rows):
    frame = spark.createDataFrame(rows, "app_id int, player_count int, _source_batch_id string, snapshot_date string")
    return frame.withColumn("snapshot_timestamp", F.col("snapshot_date").cast("timestamp"))


@pytest.mark.parametrize("broken", ["append", "close_units"])
def test_a_run_that_broke_off_is_settled(spark, tmp_path, monkeypatch, broken):
    path = str(tmp_path / "fact")
    old, new = player_source(spark, [(1, 1, "a", "2024-01-01")]), player_source(spark, [(2, 2, "b", "2024-01-02"), (3, 3, "b", "2024-01-02")])
    silver.append_players(spark, old, path, "2024-02-01")
    target = tables if broken == "append" else ledger

    def fail(*_):
        raise OSError("lost")

    monkeypatch.setattr(target, broken, fail)
    with pytest.raises(OSError):
        silver.append_players(spark, old.union(new), path, "2024-02-01")
    monkeypatch.undo()
    counts = silver.append_players(spark, old.union(new), path, "2024-02-01").first()
    assert (counts["processed"], counts["inserted"]) == (3, 2 if broken == "append" else 0)
    assert tables.read(spark, path, registry.PLAYER_FACT.ddl).count() == 3


def test_a_batch_there_in_part_is_named(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "fact")
    new = player_source(spark, [(2, 2, "b", "2024-01-02"), (3, 3, "b", "2024-01-02")])
    silver.append_players(spark, new.filter("false"), path, "2024-02-01")
    whole = tables.append

    def half(rows, *rest):
        whole(rows.filter("app_id = 2"), *rest)
        raise OSError("lost")

    monkeypatch.setattr(tables, "append", half)
    with pytest.raises(OSError):
        silver.append_players(spark, new, path, "2024-02-01")
    monkeypatch.undo()
    with pytest.raises(RuntimeError, match="batch b"):
        silver.append_players(spark, new, path, "2024-02-01")


def test_a_ledger_is_begun_from_the_fact(spark, tmp_path):
    path = str(tmp_path / "fact")
    old = player_source(spark, [(1, 1, "a", "2024-01-01"), (2, 1, "a", "2024-01-01")])
    tables.append(old.withColumn("_created_at", F.lit("2024-01-05").cast("timestamp")), path, registry.PLAYER_FACT.partition_by)
    assert silver.append_players(spark, old, path, "2024-02-01").first()["inserted"] == 0
    assert silver.append_players(spark, old.filter("app_id = 1"), path, "2024-02-01").first()["inserted"] == 1  # other content


def test_writers_at_the_same_time_get_versions_of_their_own(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.claim(spark, path, 0)  # a writer that has not finished
    assert tables.replace(spark.range(3), path) == 1
    spark.range(7).write.mode("overwrite").parquet(f"{path}/v=0")
    assert tables.finished_versions(spark, path) == [0, 1] and tables.read_replaced(spark, path).count() == 3
    assert not tables.claim(spark, path, 1)
    assert tables.replace(spark.range(4), path) == 2
    with pytest.raises(Exception):
        tables.replace(spark.range(2).select(F.raise_error(F.lit("broken")).alias("x")), path)
    assert tables.replace(spark.range(5), path) == tables.newest_version(spark, path)


def test_an_old_claim_is_taken_over(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.claim(spark, path, 0) and not tables.claim(spark, path, 0)
    assert tables.claim(spark, path, 0, lease=-1)


DIM = Dimension("app_id", ("price",), "sk")


def test_a_merge_that_came_second_is_begun_anew(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "dim")
    rows = lambda *found: spark.createDataFrame(found, "app_id int, price int")
    silver.merge_dimension(spark, rows((1, 10), (2, 20)), DIM, path, "2024-01-01")
    write, others = tables.write_merge, []

    def late(*args):
        if not others:  # another writer gets in between reading and writing
            others.append(1)
            silver.merge_dimension(spark, rows((1, 11), (3, 30)), DIM, path, "2024-01-02")
        return write(*args)

    monkeypatch.setattr(tables, "write_merge", late)
    counts = silver.merge_dimension(spark, rows((2, 22), (3, 30)), DIM, path, "2024-01-03").first()
    assert (counts["inserted"], counts["updated"], counts["unchanged"]) == (0, 1, 1)
    found = tables.read_history(spark, path).select("app_id", "price", "is_current", "sk").collect()
    assert sorted(map(tuple, found)) == [(1, 10, False, 1), (1, 11, True, 3), (2, 20, False, 2), (2, 22, True, 5), (3, 30, True, 4)]
    with pytest.raises(tables.Conflict):
        tables.write_dimension(tables.read_current(spark, path), tables.read_current(spark, path), path, 0)


def test_release_keeps_the_newest_and_the_history(spark, tmp_path):
    path = str(tmp_path / "dim")
    for day, price in (("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 3), ("2024-01-04", 4)):
        silver.merge_dimension(spark, spark.createDataFrame([(1, price)], "app_id int, price int"), DIM, path, day)
    before = tables.read_history(spark, path).collect()
    assert tables.release_slices(spark, path) == 2
    assert tables.finished_versions(spark, f"{path}/current") == [2, 3]
    assert sorted(map(str, tables.read_history(spark, path).collect())) == sorted(map(str, before))
    with pytest.raises(ValueError):
        tables.release_slices(spark, path, 0)
    for n in (3, 4, 5):
        assert tables.replace(spark.range(n), f"{path}-table") == n - 3
    assert tables.release(spark, f"{path}-table", 1) == [0, 1] and tables.read_replaced(spark, f"{path}-table").count() == 5


def written(path):
    return sum(f.stat().st_size for f in path.rglob("*.parquet"))


def test_a_merge_writes_what_it_changes(spark, tmp_path):
    path, many = tmp_path / "dim", 20_000
    prices = lambda moved: spark.range(many).select(
        F.col("id").cast("int").alias("app_id"), F.when(F.col("id") < moved, 2).otherwise(1).alias("price"), F.md5(F.col("id").cast("string")).alias("name")
    )
    silver.merge_dimension(spark, prices(0), DIM, str(path), "2024-01-01")
    whole = written(path / "current/v=0")
    for number, (moved, most) in enumerate(((0, 0), (1, 1 / 12), (3, 3 / 12)), 1):
        silver.merge_dimension(spark, prices(moved), DIM, str(path), f"2024-01-0{number + 1}")
        assert written(path / f"current/v={number}") <= most * whole
    history = tables.read_history(spark, str(path))
    assert history.count() == many + 3 and history.filter("is_current").count() == many
    assert sorted(r["app_id"] for r in history.filter("is_current and price = 2").collect()) == [0, 1, 2]
    held = tables.manifest(spark, str(path), 3)
    assert held["rows"] == many and len(held["held"]) == 16 and 2 <= len(set(held["held"].values())) <= 3
    before = sorted(map(str, history.collect()))
    tables.release_slices(spark, str(path), 1)
    assert sorted(map(str, tables.read_history(spark, str(path)).collect())) == before


def test_more_buckets_and_new_columns(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "dim")
    monkeypatch.setattr(tables, "BUCKET_ROWS", 2)
    monkeypatch.setattr(tables, "BUCKETS", (1, 64))
    one = spark.createDataFrame([(1, 10), (2, 20)], "app_id int, price int")
    silver.merge_dimension(spark, one, DIM, path, "2024-01-01")
    more = spark.range(3, 40).select(F.col("id").cast("int").alias("app_id"), F.lit(5).alias("price"), F.lit("x").alias("label"))
    silver.merge_dimension(spark, more, DIM, path, "2024-01-02")
    assert tables.manifest(spark, path, 0)["buckets"] == 1 and tables.manifest(spark, path, 1)["buckets"] > 8
    silver.merge_dimension(spark, spark.createDataFrame([(2, 21)], "app_id int, price int"), DIM, path, "2024-01-03")
    rows = {r["app_id"]: (r["price"], r["label"]) for r in tables.read_current(spark, path).collect()}
    assert len(rows) == 39 and rows[1] == (10, None) and rows[2] == (21, None) and rows[30] == (5, "x")
    assert tables.read_history(spark, path).count() == 40


def test_failed_answers_keep_what_was_answered(spark, tmp_path):
    root, at = str(tmp_path), datetime(2024, 1, 1)

    def land(kind, texts, ddl):
        rows = [(k, at, "r", t if t is None else json.dumps(t)) for k, t in texts.items()]
        bronze.land(spark, spark.createDataFrame(rows, "app_id int, ingested_at timestamp, run string, response string"), kind, root, "run")
        records = read_batches(spark, landing_path(root, kind), ddl).collect()
        return {r["request_params"]["app_id"]: r["raw_data"] for r in records}

    store = land("store", {1: {"1": {"success": False}}, 2: {"2": {"success": True, "data": {"item_id": 2, "type": "game"}}}, 3: None}, store_ddl())
    assert json.loads(store[1]["raw_response"]) == {"1": {"success": False}}
    assert store[2]["type"] == "game" and store[2]["developers"] is None and "item_id" in store[2]["raw_response"]
    assert store[3]["raw_response"] is None and "success=false" in store[3]["error"]
    reviews = land("reviews", {1: {"success": 2, "query_summary": {"total_reviews": 5}}}, reviews_ddl())
    assert reviews[1]["query_summary"]["total_reviews"] == 5 and reviews[1]["success"] == 2
    players = land("player_stats", {1: {"player_count": -5, "result": 1}, 2: {"player_count": 7, "result": 42}, 3: {"player_count": 7, "result": 1}}, PLAYERS_DDL)
    assert [players[k]["player_count"] for k in (1, 2, 3)] == [-5, 7, 7]
    assert [players[k]["raw_response"] is None for k in (1, 2, 3)] == [False, False, True]
