"""Contract rules, defaults and derived fields on hand-made payloads."""

from __future__ import annotations

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tierkeep.operators import contracts as c
from tierkeep.sources.schemas import PLAYERS_DDL, PayloadNames, reviews_ddl, store_ddl


def payload(spark, data, ddl):
    return spark.createDataFrame([(json.dumps(data),)], "text string").select(F.from_json("text", ddl).alias("p"))


def broken(spark, data, ddl, rules):
    return c.checked(payload(spark, data, ddl), rules(F.col("p"))).first()["violations"]


ITEM = {"item_id": 10, "name": "Alpha", "type": "game"}
PRICE = {"currency": "USD", "initial": 5999, "final": 2999, "discount_percent": 50}


def test_minimal_item_is_valid_and_gets_defaults(spark):
    assert broken(spark, ITEM, store_ddl(), c.store_rules) == []
    item = payload(spark, ITEM, store_ddl()).select(c.with_store_defaults(F.col("p")).alias("p")).first()["p"]
    assert (item["is_free"], item["required_age"], item["short_description"]) == (False, 0, "")
    assert item["genres"] == item["categories"] == item["developers"] == item["screenshots"] == []
    assert item["platforms"].asDict() == {"windows": False, "mac": False, "linux": False}
    assert item["release_date"].asDict() == {"coming_soon": False, "date": ""}
    assert item["price_overview"] is None and item["metacritic"] is None and item["website"] is None


@pytest.mark.parametrize(
    ("change", "rules"),
    [
        ({"name": None}, ["name_required"]),
        ({"type": None, "item_id": None}, ["item_id_required", "type_required"]),
        ({"price_overview": PRICE}, []),
        ({"price_overview": {**PRICE, "discount_percent": 150}}, ["price_discount_percent_range"]),
        ({"price_overview": {**PRICE, "discount_percent": -1}}, ["price_discount_percent_range"]),
        ({"price_overview": {"currency": "USD", "initial": 1, "discount_percent": 0}}, ["price_final_required"]),
        ({"metacritic": {"score": 100}}, []),
        ({"metacritic": {"score": 101}}, ["metacritic_score_range"]),
        ({"metacritic": {"url": "u"}}, ["metacritic_score_required"]),
        ({"genres": [{"id": "1", "description": "Action"}, {"id": "2"}]}, ["genres_complete"]),
    ],
)
def test_store_rules(spark, change, rules):
    assert broken(spark, {**ITEM, **change}, store_ddl(), c.store_rules) == rules


def test_store_derived_fields(spark):
    data = {**ITEM, "price_overview": PRICE, "genres": [{"id": "1", "description": "Action"}, {"id": "3", "description": "RPG"}]}
    row = payload(spark, data, store_ddl()).select(*[v.alias(k) for k, v in c.store_derived(F.col("p")).items()]).first()
    assert (row["initial_dollars"], row["final_dollars"]) == (Decimal("59.99"), Decimal("29.99"))
    assert row["genre_names"] == ["Action", "RPG"] and row["category_names"] is None


@pytest.mark.parametrize(("age", "expected"), [("18", 18), (18, 18), ("18+", 0), ("", 0)])
def test_required_age(spark, age, expected):
    filled = payload(spark, {**ITEM, "required_age": age}, store_ddl()).select(c.with_store_defaults(F.col("p")).alias("p"))
    assert filled.first()["p"]["required_age"] == expected


def test_vendor_field_names(spark):
    names = PayloadNames(item_id="vendor_appid")
    data = {"vendor_appid": 5, "name": "A", "type": "game"}
    assert broken(spark, data, store_ddl(names), lambda p: c.store_rules(p, names)) == []


@pytest.mark.parametrize(("key", "rules"), [(1, []), (0, ["app_id_min"]), (-3, ["app_id_min"]), (None, ["app_id_required"])])
def test_key_rules(spark, key, rules):
    frame = spark.createDataFrame([(key,)], "k int")
    assert c.checked(frame, c.key_rules(F.col("k"))).first()["violations"] == rules


@pytest.mark.parametrize(
    ("summary", "rules", "ratio"),
    [
        ({"total_positive": 80, "total_reviews": 100, "review_score": 9}, [], 0.8),
        ({"total_reviews": 0}, [], None),
        ({}, [], None),
        ({"review_score": 10}, ["review_score_range"], None),
        ({"total_negative": -1, "total_reviews": -1}, ["total_negative_min", "total_reviews_min"], None),
    ],
)
def test_summary(spark, summary, rules, ratio):
    frame = payload(spark, {"success": 1, "query_summary": summary}, reviews_ddl()).select(
        c.with_summary_defaults(F.col("p.query_summary")).alias("s")
    )
    row = c.checked(frame, c.summary_rules(F.col("s"))).withColumn("ratio", c.summary_ratio(F.col("s"))).first()
    assert row["violations"] == rules and row["ratio"] == ratio
    assert row["s"]["review_score_desc"] == "" and row["s"]["num_reviews"] == 0


def test_single_reviews(spark):
    good = {
        "recommendationid": "r1", "author": {"author_id": "u", "playtime_at_review": 90}, "timestamp_created": 0,
        "timestamp_updated": 60, "voted_up": True,
    }
    bad = {**good, "recommendationid": None, "votes_up": -1, "author": {"playtime_forever": -5}}
    records = payload(spark, {"success": 1, "reviews": [good, bad]}, reviews_ddl()).select(
        F.struct(F.lit(7).alias("app_id")).alias("request_params"), F.col("p").alias("raw_data")
    )
    first, second = c.single_reviews(records).collect()
    assert first["violations"] == [] and first["playtime_hours"] == 1.5 and first["app_id"] == 7
    assert (first["updated_at"] - first["created_at"]).seconds == 60
    assert second["violations"] == ["recommendationid_required", "author_id_required", "playtime_forever_min", "votes_up_min"]
    assert second["playtime_hours"] == 0.0


@pytest.mark.parametrize(
    ("data", "rules"),
    [
        ({"player_count": 45000, "result": 1}, []),
        ({"player_count": 0, "result": 42}, []),
        ({"player_count": -100, "result": 1}, ["player_count_min"]),
        ({"result": 1}, ["player_count_required"]),
        ({"player_count": 1}, ["result_required"]),
    ],
)
def test_player_rules(spark, data, rules):
    assert broken(spark, data, PLAYERS_DDL, c.player_rules) == rules


def test_routing_keeps_every_row(spark):
    frame = spark.createDataFrame([(1, 5), (2, -1), (3, None)], "k int, v int")
    valid, quarantine = c.routed(c.checked(frame, [c.at_least("v", F.col("v"))]))
    assert sorted(r["k"] for r in valid.collect()) == [1, 3]
    assert [(r["k"], r["violations"]) for r in quarantine.collect()] == [(2, ["v_min"])]


def test_validation_turns_success_into_failure(spark):
    rows = spark.createDataFrame([(True, []), (True, ["v_min"]), (False, [])], "ok boolean, broken array<string>")
    status, message = c.validated(F.col("ok"), F.col("broken"), F.lit("refused"))
    found = rows.select(status.alias("s"), F.when(~status, message).alias("m")).collect()
    assert [tuple(r) for r in found] == [(True, None), (False, "contract: v_min"), (False, "refused")]
