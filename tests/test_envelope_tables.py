from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tierkeep.operators import envelope as e
from tierkeep.plans.health import table_health, version_census, within_retention
from tierkeep.sources import registry, tables
from tierkeep.sources.batches import read_batches, write_batches
from tierkeep.sources.schemas import PLAYERS_DDL, struct_of


def test_unwrap_keyed(spark):
    rows = spark.createDataFrame(
        [(1, '{"1": {"success": true, "data": {"v": 5}}}'), (2, '{"2": {"success": false}}'), (3, "{}"), (4, "no json"),
         (5, '{"6": {"success": true, "data": {"v": 1}}}'), (6, None)],
        "k int, text string",
    )
    ok, data = e.unwrap_keyed(F.col("text"), F.col("k"), "v int")
    found = rows.select("k", ok.alias("ok"), data["v"].alias("v")).orderBy("k").collect()
    assert [tuple(r) for r in found] == [(1, True, 5), (2, False, None), (3, False, None), (4, False, None), (5, False, None), (6, False, None)]


def test_stored_payload(spark):
    rows = spark.createDataFrame(
        [(True, (1,), "raw", None), (False, (1,), "raw", "bad"), (False, None, None, "bad"), (False, None, None, None)],
        "ok boolean, data struct<v: int>, raw string, error string",
    )
    columns = [F.col(c) for c in ("ok", "data", "raw", "error")]
    kept = rows.select(e.stored_payload(*columns).alias("a"), e.stored_payload(*columns, keep_raw=False).alias("b")).collect()
    assert [tuple(r) for r in kept] == [
        ('{"v":1}', '{"v":1}'), ("raw", '{"error":"bad"}'), ('{"error":"bad"}', '{"error":"bad"}'), ('{"error":null}', '{"error":null}'),
    ]


def test_batch_statistics(spark):
    rows = spark.createDataFrame([("a", True)] * 3 + [("a", False), ("b", None)], "batch string, ok boolean")
    found = {r["batch"]: r for r in e.batch_statistics(rows, ["batch"], F.col("ok")).collect()}
    assert (found["a"]["total_requested"], found["a"]["total_success"], found["a"]["total_failed"], found["a"]["success_rate"]) == (4, 3, 1, 75.0)
    assert found["b"]["success_rate"] == 0.0
    assert spark.range(1).select(e.success_rate(F.lit(0), F.lit(0)).alias("r")).first()["r"] is None


def test_run_statistics(spark):
    records = spark.createDataFrame([(1, True), (2, True), (3, True), (4, False)], "k int, ok boolean")
    keys = spark.createDataFrame([(1,), (2,)], "k int")
    row = e.run_statistics(records, keys, 2, F.col("ok")).first()
    assert (row["operations"], row["successful"], row["failed"], row["success_rate"], row["status"]) == (4, 3, 1, 75.0, "partial")
    none = e.run_statistics(records.filter("false"), keys.filter("false"), 3, F.col("ok")).first()
    assert (none["operations"], none["success_rate"], none["status"]) == (0, 100.0, "success")


def _records(spark, rows):
    frame = spark.createDataFrame(rows, "app_id int, at timestamp, n int, ok boolean")
    payload = F.struct(F.col("n").alias("player_count"), F.when(F.col("ok"), 1).otherwise(0).alias("result"))
    return e.stamped(
        frame.withColumn("raw_data", payload), key="app_id", batch=F.date_format("at", "yyyyMMdd"), source=F.lit("player_stats_api"),
        endpoint=F.lit("players"), ingested_at=F.col("at"), succeeded=F.col("ok"), error=F.lit("refused"),
    )


def test_batches_round_trip(spark, tmp_path):
    from datetime import datetime

    rows = [(i, datetime(2024, 1, 1 + i % 2, 10, 0, i), i * 10, i % 3 > 0) for i in range(10)]
    path = str(tmp_path / "raw")
    with pytest.raises(ValueError, match="more than 1"):
        write_batches(_records(spark, rows), path, limit=1)
    write_batches(_records(spark, rows), path)
    assert sorted(p.name for p in Path(path).glob("date=*")) == ["date=2024-01-01", "date=2024-01-02"]
    documents = [json.loads(line) for f in Path(path).rglob("*.json") for line in f.read_text().splitlines()]
    assert {d["batch_id"]: (d["statistics"]["total_requested"], d["statistics"]["total_failed"]) for d in documents} == {
        "20240101": (5, 2), "20240102": (5, 2),
    }
    back = read_batches(spark, path, PLAYERS_DDL)
    found = {(r["request_params"]["app_id"], r["raw_data"]["player_count"], r["status"]) for r in back.collect()}
    assert found == {(i, n, "success" if ok else "failed") for i, _, n, ok in rows}
    assert {tuple(r) for r in e.run_errors(_records(spark, rows)).collect()} == {("player_stats_api", i, "refused") for i in (0, 3, 6, 9)}


def test_record_ids_repeat_on_retry(spark):
    from datetime import datetime

    rows = [(1, datetime(2024, 1, 1), 1, True), (2, datetime(2024, 1, 1), 1, True)]
    first, second = ([r["metadata"]["record_id"] for r in _records(spark, rows).collect()] for _ in range(2))
    assert first == second and len(set(first)) == 2


def test_replace_keeps_unfinished_versions_out(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.newest_version(spark, path) is None
    assert tables.replace(spark.range(3), path) == 0
    assert tables.replace(spark.range(5).withColumn("x", F.lit(1)), path) == 1
    (tmp_path / "t" / "v=2").mkdir()
    (tmp_path / "t" / "v=2" / "part-0.parquet").write_text("half written")
    assert tables.read_replaced(spark, path).count() == 5
    assert tables.read_replaced(spark, path, version=0).count() == 3
    # a table may be replaced by something computed from itself
    assert tables.replace(tables.read_replaced(spark, path).filter("id > 1"), path) == 2
    assert tables.read_replaced(spark, path).count() == 3


def test_append_and_read_with_declared_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append(spark.range(2), path)
    tables.append(spark.range(2, 4).withColumn("x", F.lit("new")), path)
    rows = sorted(tuple(r) for r in tables.read(spark, path, "id bigint, x string").fillna("-").collect())
    assert rows == [(0, "-"), (1, "-"), (2, "new"), (3, "new")]
    assert set(tables.read(spark, path, merge_schema=True).columns) == {"id", "x"}


def test_orc_works_as_well(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append(spark.range(3), path, fmt="orc")
    assert tables.read(spark, path, "id bigint", fmt="orc").count() == 3


def test_dimension_commit_is_the_current_slice(spark, tmp_path):
    path = str(tmp_path / "dim")
    spec = registry.REVIEW_DIM
    empty = registry.empty_table(spark, spec)
    assert tables.read_current(spark, path) is None
    tables.write_dimension(empty, empty, path)
    assert tables.read_history(spark, path).count() == 0
    # closed versions of a merge that failed before writing its slice are not seen
    (tmp_path / "dim" / "closed" / "v=1").mkdir()
    (tmp_path / "dim" / "closed" / "v=1" / "part-0.parquet").write_text("half written")
    assert tables.read_history(spark, path).count() == 0


def test_all_declared_tables_can_be_created(spark, tmp_path):
    root = str(tmp_path)
    for spec in registry.ALL_TABLES:
        tables.create_empty(spark, spec, root)
        frame = tables.read_table(spark, spec, root)
        assert frame.count() == 0 and set(frame.columns) == set(struct_of(spec.ddl).names), spec.name
    assert {s.name for s in registry.ALL_TABLES if s.tier == "silver"} == {"dim_games", "dim_game_reviews", "fact_player_counts"}


def test_health_reports_missing_tables(spark, tmp_path):
    rows = {r["table_name"]: r for r in table_health(spark, {"here": lambda: spark.range(3), "gone": lambda: spark.read.parquet(str(tmp_path / "no"))}).collect()}
    assert (rows["here"]["records"], rows["here"]["success"]) == (3, True)
    assert rows["gone"]["success"] is False and "no" in rows["gone"]["error"]


def test_retention_and_census(spark):
    days = spark.createDataFrame([("2024-01-01",), ("2024-01-25",), ("2024-01-31",)], "d string").withColumn("d", F.col("d").cast("date"))
    assert within_retention(days, F.col("d"), "2024-01-31", 6).count() == 2
    assert within_retention(days, F.col("d"), "2024-01-31", None).count() == 3
    census = version_census(spark.createDataFrame([(True,), (False,), (False,)], "is_current boolean"))
    assert {r["is_current"]: r["versions"] for r in census.collect()} == {True: 1, False: 2}
