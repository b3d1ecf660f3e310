"""Landed documents to silver to gold, in full and in pieces, and the incremental form."""

from __future__ import annotations

import shutil
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests import landing
from tierkeep.plans import gold, silver
from tierkeep.sources import registry, tables
from tierkeep.sources.batches import read_batches
from tierkeep.sources.schemas import PLAYERS_DDL, struct_of
from tierkeep.streaming.ingest import ingest_new


def counts(results):
    return {r["table_name"]: (r["processed"], r["inserted"], r["updated"], r["unchanged"]) for r in results.collect()}


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tiers"))
    landing.first_day(root)
    first = counts(silver.run_silver(spark, root, root, as_of="2024-01-01 20:00:00"))
    landing.second_day(root)
    second = counts(silver.run_silver(spark, root, root, as_of="2024-01-02 20:00:00"))
    third = counts(silver.run_silver(spark, root, root, as_of="2024-01-03 20:00:00"))
    results = gold.run_gold(spark, root, root, as_of="2024-01-03 21:00:00").collect()
    return root, (first, second, third), results


def test_silver_counts(built):
    first, second, third = built[1]
    assert first == {"dim_games": (3, 3, 0, 0), "dim_game_reviews": (2, 2, 0, 0), "fact_player_counts": (2, 2, 0, 0)}
    # the second run sees all batches again; item 2 keeps its first record, item 3 only changed its name
    assert second == {"dim_games": (4, 1, 1, 2), "dim_game_reviews": (2, 0, 0, 2), "fact_player_counts": (4, 2, 0, 2)}
    assert third == {"dim_games": (4, 0, 0, 4), "dim_game_reviews": (2, 0, 0, 2), "fact_player_counts": (4, 0, 0, 4)}


def test_item_versions(spark, built):
    history = tables.read_history(spark, registry.ITEM_DIM.path(built[0]))
    found = sorted((r["app_id"], r["game_sk"], r["price_final_cents"], r["is_current"]) for r in history.collect() if r["app_id"] != 2)
    assert found == [(1, 1, 2999, False), (1, 4, 5999, True), (3, 3, 5999, True), (5, 5, 999, True)]
    old, new = history.filter("app_id = 1").orderBy("game_sk").collect()
    assert old["valid_to"] == new["valid_from"] == datetime(2024, 1, 2, 20)
    assert old["genres"] == ["Action", "RPG"] and old["_source_batch_id"] == "s1"
    assert history.filter("app_id = 3").first()["name"] == "Item 3"
    declared = set(struct_of(registry.ITEM_DIM.ddl).names)
    assert set(history.columns) == declared


def test_review_ratio(spark, built):
    rows = {r["app_id"]: r for r in tables.read_current(spark, registry.REVIEW_DIM.path(built[0])).collect()}
    assert round(rows[1]["positive_ratio"], 4) == 0.7895
    assert rows[3]["positive_ratio"] is None


def test_gold_results(built):
    assert [(r["table_name"], r["records"], r["success"]) for r in built[2]] == [
        ("agg_game_metrics", 4, True), ("agg_price_history", 5, True), ("agg_genre_summary", 3, True),
    ]


def test_item_metrics(spark, built):
    frame = tables.read_table(spark, registry.ITEM_METRICS, built[0])
    assert frame.columns == struct_of(registry.ITEM_METRICS.ddl).names
    assert [f.dataType for f in frame.schema] == [f.dataType for f in struct_of(registry.ITEM_METRICS.ddl)]
    rows = {r["app_id"]: r for r in frame.collect()}
    one = rows[1]
    assert (one["price_usd"], one["is_on_sale"], one["genres"], one["developers"]) == (59.99, False, "Action", "Dev A, Dev B")
    # the newest day holds two counts of item 1: the later one counts
    assert (one["current_players"], one["player_count_updated_at"]) == (200, datetime(2024, 1, 2, 12))
    # items without a count on the newest day have none
    assert rows[2]["current_players"] is None and rows[2]["popularity_score"] == 0.0
    assert rows[2]["is_on_sale"] is False and rows[2]["price_usd"] is None and rows[2]["genres"] == ""
    assert rows[5]["is_on_sale"] is True


def test_price_history(spark, built):
    frame = tables.read_table(spark, registry.PRICE_HISTORY, built[0])
    assert frame.columns == struct_of(registry.PRICE_HISTORY.ddl).names
    rows = {(r["app_id"], r["is_current"]): r for r in frame.collect()}
    sale = rows[(1, False)]
    assert (sale["discount_tier"], sale["discount_amount_usd"], sale["is_discounted"]) == ("Large (50-74%)", 30.0, True)
    assert sale["effective_date"] == "2024-01-01"
    assert rows[(2, True)]["discount_tier"] == "Huge (75%+)" and rows[(2, True)]["is_discounted"] is False
    assert rows[(1, True)]["discount_tier"] == "No Discount"
    points = gold.price_series(frame, 1).collect()
    assert [p["price_final_usd"] for p in points] == [29.99, 59.99]


def test_genre_summary(spark, built):
    frame = tables.read_table(spark, registry.GENRE_SUMMARY, built[0])
    assert frame.columns == struct_of(registry.GENRE_SUMMARY.ddl).names
    assert [f.dataType for f in frame.schema] == [f.dataType for f in struct_of(registry.GENRE_SUMMARY.ddl)]
    rows = {r["genre"]: r for r in frame.collect()}
    unknown = rows["Unknown"]  # one NULL and one empty genre list
    assert (unknown["game_count"], unknown["free_games_count"], unknown["percent_free"]) == (2, 1, 50.0)
    assert unknown["avg_price_usd"] == 59.99 and unknown["total_current_players"] is None
    assert rows["Action"]["total_current_players"] == 200 and rows["Action"]["games_with_metacritic"] == 1
    assert rows["RPG"]["percent_on_sale"] == 100.0 and rows["RPG"]["max_price_usd"] == 9.99


def test_duplicate_genres_inflate_sums_but_not_the_count(spark):
    rows = spark.createDataFrame(
        [(1, ["A", "A"], False, 100, 0, None, 3, 0.5, 1, 10)],
        "app_id int, genres array<string>, is_free boolean, price_final_cents int, price_discount_percent int, "
        "metacritic_score int, total_reviews int, positive_ratio double, review_score int, current_players int",
    )
    row = gold.group_summary(rows, F.col("genres"), "2024-01-01").first()
    assert (row["game_count"], row["total_reviews"], row["total_current_players"]) == (1, 6, 20)


def test_reports(spark, built):
    metrics = tables.read_table(spark, registry.ITEM_METRICS, built[0])
    cards = gold.kpi_cards(metrics).first()
    assert (cards["total_games"], cards["total_players"], cards["on_sale_percent"]) == (4, 200, 25.0)
    assert cards["avg_price_usd"] == 43.32  # 59.99, 59.99 and 9.99
    assert [r["app_id"] for r in gold.top_items(metrics, "current_players", 2).collect()] == [1, 2]
    summary = tables.read_table(spark, registry.GENRE_SUMMARY, built[0])
    assert {r["genre"]: r["share_percent"] for r in gold.shares(summary, "genre", "game_count").collect()} == {
        "Unknown": 50.0, "Action": 25.0, "RPG": 25.0,
    }


def test_current_views(spark, built):
    assert silver.current_views(spark, built[0]) == ["current_dim_games", "current_dim_game_reviews"]
    found = spark.sql("select count(*) n, count_if(is_current) c from current_dim_games").first()
    assert (found["n"], found["c"]) == (4, 4)


def test_latest_players_from_the_newest_folder_only(spark, built):
    stored = gold.stored_latest_players(spark, built[0])
    general = gold.latest_players(tables.read_table(spark, registry.PLAYER_FACT, built[0]))
    assert {tuple(r) for r in stored.collect()} == {tuple(r) for r in general.collect()}
    assert all("snapshot_date=2024-01-02" in f for f in stored.inputFiles())


def test_failures_stay_with_their_table(spark, tmp_path):
    root = str(tmp_path)
    landing.first_day(root)
    results = silver.run_silver(spark, root, root + "/silver", as_of="2024-01-01", include=("items", "players"))
    assert set(counts(results)) == {"dim_games", "fact_player_counts"}
    empty = str(tmp_path / "elsewhere")
    failed = silver.run_silver(spark, empty, root + "/other", as_of="2024-01-01")
    assert [r["success"] for r in failed.collect()] == [False] * 3
    totals = silver.run_totals(failed).first()
    assert totals["total_processed"] == 0 and totals["all_successful"] is False
    built = gold.run_gold(spark, root + "/silver", root + "/gold", as_of="2024-01-01").collect()
    assert [r["success"] for r in built] == [False, True, False]  # no review dimension there
    assert "dim_game_reviews" in built[0]["error"]


def test_pretty_printed_documents_in_another_folder(spark, tmp_path):
    landing.first_day(tmp_path, pretty=True)
    landed = tmp_path / "Files" / "bronze"
    folders = {kind: f"raw_vendor_{kind}" for kind in ("store", "reviews", "player_stats")}
    for kind, folder in folders.items():
        shutil.copytree(landed / f"raw_{kind}", tmp_path / "other" / "Files" / "bronze" / folder)
    results = silver.run_silver(
        spark, str(tmp_path / "other"), str(tmp_path), as_of="2024-01-01", multi_line=True, folders=folders
    )
    assert counts(results)["dim_games"] == (3, 3, 0, 0)


def test_folder_of_failures_reads_with_all_columns(spark, tmp_path):
    landing.land(tmp_path, "player_stats", "2024-01-01", "p", [landing.record("p", "player_stats_api", 1, "2024-01-01T00:00:00", None, ok=False)])
    path = silver.landing_path(str(tmp_path), "player_stats")
    records = read_batches(spark, path, PLAYERS_DDL)
    assert records.select("raw_data.player_count").first()["player_count"] is None
    assert silver.player_rows(records).count() == 0


def test_since_reads_only_newer_folders(spark, tmp_path):
    landing.first_day(tmp_path)
    landing.second_day(tmp_path)
    path = silver.landing_path(str(tmp_path), "player_stats")
    recent = read_batches(spark, path, PLAYERS_DDL, since="2024-01-02")
    assert {r["batch_id"] for r in recent.collect()} == {"p2"}
    assert len(recent.inputFiles()) >= 1
    assert "PartitionFilters: [isnotnull(date" in recent._jdf.queryExecution().executedPlan().toString()


def test_incremental_ingest_equals_full_runs(spark, tmp_path):
    root, state = str(tmp_path), str(tmp_path / "state")

    def take_in(stamp):
        for kind in ("store", "reviews", "player_stats"):
            ingest_new(spark, kind, root, root, state, as_of=stamp)

    landing.first_day(root)
    take_in("2024-01-01 20:00:00")
    landing.second_day(root)
    take_in("2024-01-02 20:00:00")
    take_in("2024-01-03 20:00:00")
    full = str(tmp_path / "full")
    landing.first_day(full)
    silver.run_silver(spark, full, full, as_of="2024-01-01 20:00:00")
    landing.second_day(full)
    silver.run_silver(spark, full, full, as_of="2024-01-02 20:00:00")
    for spec in (registry.ITEM_DIM, registry.REVIEW_DIM):
        left, right = (tables.read_history(spark, spec.path(r)) for r in (root, full))
        assert left.count() == right.count() and left.select(right.columns).exceptAll(right).count() == 0
    left, right = (tables.read(spark, registry.PLAYER_FACT.path(r), registry.PLAYER_FACT.ddl) for r in (root, full))
    assert left.count() == right.count() == 4 and left.exceptAll(right).count() == 0


@pytest.mark.parametrize("files_per_batch", [1, 2, 1000])
@pytest.mark.parametrize("days", [(1, 2, 3), (3, 1, 2)])
def test_streamed_history_does_not_depend_on_grouping_or_order(spark, tmp_path, files_per_batch, days):
    """Three prices of one item in one run, then a late file: the newest price stays current throughout."""
    root, state = str(tmp_path), str(tmp_path / "state")

    def land(day, price, batch):
        at = f"2024-01-0{day}T10:00:00"
        landing.land(root, "store", at[:10], batch, [landing.record(batch, "store_api", 1, at, landing.item(1, price))])

    def take_in(stamp):
        row = ingest_new(spark, "store", root, root, state, as_of=stamp, files_per_batch=files_per_batch).first()
        history = tables.read_history(spark, registry.ITEM_DIM.path(root))
        return tuple(row), sorted((r["price_final_cents"], r["valid_from"], r["is_current"]) for r in history.collect())

    for day in days:
        land(day, day * 100, f"b{day}")
    first = (300, datetime(2024, 1, 9), True)
    assert take_in("2024-01-09") == ((1, 1, 0, 0, 0), [first])
    land(2, 250, "late")
    assert take_in("2024-01-10") == ((1, 0, 0, 1, 0), [first])
    assert take_in("2024-01-11") == ((0, 0, 0, 0, 0), [first])
    land(4, 400, "b4")
    closed = (300, datetime(2024, 1, 9), False)
    assert take_in("2024-01-12") == ((1, 0, 1, 0, 0), [closed, (400, datetime(2024, 1, 12), True)])


def test_a_streamed_run_that_broke_off_is_taken_up(spark, tmp_path, monkeypatch):
    from tierkeep.streaming import ingest

    root, state = str(tmp_path), str(tmp_path / "state")
    landing.first_day(root)

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(ingest, "merge_dimension", fail)
        with pytest.raises(OSError):
            ingest_new(spark, "store", root, root, state, as_of="2024-01-01")
    row = ingest_new(spark, "store", root, root, state, as_of="2024-01-02").first()
    assert (row["processed"], row["inserted"]) == (3, 3)


def test_player_batches_are_looked_up_from_their_first_day_on(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = "select {0} app_id, timestamp'{1}' snapshot_timestamp, 5 player_count, '{2}' _source_batch_id, '{1}' snapshot_date"
    old, new = (spark.sql(rows.format(1, day, name)) for day, name in (("2024-01-01", "a"), ("2024-01-02", "b")))
    found = [silver.append_players(spark, r, path, "2024-02-01").first()["inserted"] for r in (old, new, old, new)]
    assert found == [1, 1, 0, 0]
    assert tables.read(spark, path, registry.PLAYER_FACT.ddl).count() == 2


@pytest.mark.parametrize("files_per_batch", [1, 1000])
def test_player_rows_without_batch_id_are_stored_each(spark, tmp_path, files_per_batch):
    root, state, at = str(tmp_path), str(tmp_path / "state"), "2024-01-01T10:00:00"

    def land(name, *found, batch=None):
        rows = [landing.record(batch, "player_api", app, at, landing.players(n)) for app, n in found]
        landing.land(root, "player_stats", "2024-01-01", name, rows)

    land("a", (1, 5), (2, 6))
    land("b", (1, 5), (3, 7), (1, 8))
    land("c", (1, 5), (1, 5), batch="c")
    want = sorted([(1, 5, "c"), (1, 5, "c"), (1, 5, None), (2, 6, None), (3, 7, None), (1, 8, None)], key=str)
    for found in ((7, 6, 0, 1, 0), (0, 0, 0, 0, 0)):
        row = ingest_new(spark, "player_stats", root, root, state, as_of="2024-01-02", files_per_batch=files_per_batch).first()
        assert tuple(row) == found
    path = registry.PLAYER_FACT.path(root)
    rows = tables.read(spark, path, registry.PLAYER_FACT.ddl).collect()
    assert sorted(((r["app_id"], r["player_count"], r["_source_batch_id"]) for r in rows), key=str) == want
    land("d", (9, 9))
    again = silver.run_silver(spark, root, root, as_of="2024-01-03", include=("players",)).first()
    assert (again["processed"], again["inserted"], again["unchanged"]) == (8, 1, 7)


def test_runs_start_from_declared_empty_tables(spark, tmp_path):
    root = str(tmp_path)
    for spec in registry.ALL_TABLES:
        tables.create_empty(spark, spec, root)
    assert [r["success"] for r in gold.run_gold(spark, root, root, as_of="2024-01-01").collect()] == [True] * 3
    landing.first_day(root)
    results = silver.run_silver(spark, root, root, as_of="2024-01-01 20:00:00")
    assert counts(results) == {"dim_games": (3, 3, 0, 0), "dim_game_reviews": (2, 2, 0, 0), "fact_player_counts": (2, 2, 0, 0)}
    history = tables.read_table(spark, registry.ITEM_DIM, root)
    assert sorted(r["game_sk"] for r in history.collect()) == [1, 2, 3]
    built = gold.run_gold(spark, root, root, as_of="2024-01-02").collect()
    assert [r["records"] for r in built] == [3, 3, 3]


def test_nothing_landed_disappears(spark, tmp_path):
    """A good record, one without item, one without a valid time, a cut-off and a pretty-printed document, '{}'."""
    root = str(tmp_path)

    def rec(name, app_id, at):
        return landing.record(name, "player_stats_api", app_id, at, {"player_count": 5, "result": 1})

    landing.land(tmp_path, "player_stats", "2024-01-01", "good", [rec("good", 1, "2024-01-01T00:00:00")])
    landing.land(tmp_path, "player_stats", "2024-01-01", "keyless", [rec("keyless", None, "2024-01-01T00:00:00")])
    landing.land(tmp_path, "player_stats", "2024-01-01", "timeless", [rec("timeless", 2, "yesterday")])
    folder = next((tmp_path / "Files" / "bronze" / "raw_player_stats").glob("date=*"))
    (folder / "torn.json").write_text('{"batch_id": "torn", "records": [{"metadata"')
    (folder / "odd.json").write_text("{}")
    (folder / "pretty.json").write_text('{\n "batch_id": "p",\n "records": []\n}')
    row = silver.run_silver(spark, root, root, as_of="2024-01-01 20:00:00", include=("players",)).first()
    assert (row["processed"], row["inserted"], row["success"]) == (1, 1, True)
    rejected = spark.read.parquet(f"{root}/rejected/{row['table_name']}")
    reasons = sorted((r["reason"], r["batch_id"]) for r in rejected.filter("batch_id is not null").collect())
    assert reasons == [("no key", "keyless"), ("no time", "timeless")]
    unreadable = rejected.filter("reason = 'unreadable'")
    assert unreadable.filter("document like '%torn%'").count() == 1 and unreadable.filter("document = ''").count() >= 1
    assert rejected.count() == row["rejected"] == 2 + unreadable.count()
    assert silver.run_silver(spark, root, root, as_of="2024-01-01", include=()).count() == 0


def test_health_isolates_a_damaged_file(spark, tmp_path):
    from tierkeep.plans.health import table_health

    spark.range(3).write.parquet(str(tmp_path / "fine"))
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "bad"))
    broken = next((tmp_path / "bad").glob("part-*.parquet"))
    broken.write_bytes(b"PAR1" + b"x" * 50)
    schema = "id bigint"
    openers = {n: (lambda n=n: spark.read.schema(schema).parquet(str(tmp_path / n))) for n in ("bad", "fine")}
    rows = {r["table_name"]: r for r in table_health(spark, openers).collect()}
    assert rows["fine"]["records"] == 3 and not rows["bad"]["success"] and rows["bad"]["error"]
