"""Column expressions against hand-computed values."""

from __future__ import annotations

import hashlib
from datetime import datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tierkeep.functions import measures as m
from tierkeep.functions import texts as t
from tierkeep.functions import times


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("players", "ratio", "expected"),
    [(45000, 450000 / 570000, 845.88), (None, None, 0.0), (999, None, 345.39), (0, 0.9, 0.0), (10, 0.0, 0.0)],
)
def test_popularity(spark, players, ratio, expected):
    assert value(spark, m.popularity(F.lit(players).cast("int"), F.lit(ratio).cast("double"))) == expected


@pytest.mark.parametrize(
    ("percent", "tier"),
    [
        (0, "No Discount"), (1, "Small (1-24%)"), (24, "Small (1-24%)"), (25, "Medium (25-49%)"),
        (49, "Medium (25-49%)"), (50, "Large (50-74%)"), (74, "Large (50-74%)"), (75, "Huge (75%+)"),
        (100, "Huge (75%+)"), (None, "Huge (75%+)"), (-5, "Small (1-24%)"),
    ],
)
def test_discount_tier(spark, percent, tier):
    assert value(spark, m.discount_tier(F.lit(percent).cast("int"))) == tier


def test_discount_tier_names_null_on_request(spark):
    assert value(spark, m.discount_tier(F.lit(None).cast("int"), null_label="Unknown")) == "Unknown"


@pytest.mark.parametrize(("part", "total", "ratio"), [(80, 100, 0.8), (5, 0, None), (5, None, None), (0, 3, 0.0)])
def test_safe_ratio(spark, part, total, ratio):
    assert value(spark, m.safe_ratio(F.lit(part), F.lit(total).cast("int"))) == ratio


def test_percent_of_zero_total_is_null(spark):
    assert value(spark, m.percent_of(F.lit(1), F.lit(0))) is None
    assert value(spark, m.percent_of(F.lit(1), F.lit(3))) == 33.33


def test_amounts(spark):
    assert value(spark, m.cents_to_amount(F.lit(5999))) == 59.99
    assert value(spark, m.cents_to_decimal(F.lit(2999))) == Decimal("29.99")
    assert value(spark, m.cents_to_amount(F.lit(None).cast("int"))) is None


@pytest.mark.parametrize(("discount", "flag"), [(10, True), (0, False), (None, False), (-0.0, False)])
def test_is_above(spark, discount, flag):
    assert value(spark, m.is_above(F.lit(discount).cast("double"))) is flag


def test_count_where_is_zero_without_matches(spark):
    assert spark.range(3).agg(m.count_where(F.col("id") > 9).alias("n")).first()["n"] == 0


@pytest.mark.parametrize(
    ("name", "hit"),
    [
        ("Alpha Soundtrack", True), ("Backpack Hero", True), ("The Post", True), ("Alpha", False), ("DEMO disc", True),
        ("alpha dlc", True), ("dlcalpha", False), ("Costumed", True), ("Pre-Order kit", True), ("", False),
    ],
)
def test_mentions(spark, name, hit):
    assert value(spark, t.mentions(F.lit(name))) is hit


def test_mentions_matches_plain_python(spark):
    names = [f"{a}{w}{b}" for w in t.ADD_ON_WORDS for a in ("", "x", "The ") for b in ("", "y", " Z")] + ["Clean", "art", "soundtrac"]
    rows = spark.createDataFrame([(n,) for n in names], "name string").select("name", t.mentions(F.col("name")).alias("hit")).collect()
    for row in rows:
        assert row["hit"] == any(w in row["name"].lower() for w in t.ADD_ON_WORDS), row["name"]


def test_mentions_whole_words(spark):
    assert value(spark, t.mentions(F.lit("Backpack Hero"), whole_word=True)) is False
    assert value(spark, t.mentions(F.lit("Hero Pack"), whole_word=True)) is True


def test_mentions_null_is_null(spark):
    assert value(spark, t.mentions(F.lit(None).cast("string"))) is None


def test_joined(spark):
    assert value(spark, t.joined(F.array(F.lit("a"), F.lit(None), F.lit("b")))) == "a, b"
    assert value(spark, t.joined(F.lit(None).cast("array<string>"))) == ""


@pytest.mark.parametrize(("text", "number"), [("18", 18), ("18+", 0), ("", 0), (None, 0), ("007", 7)])
def test_digits_or_zero(spark, text, number):
    assert value(spark, t.digits_or_zero(F.lit(text).cast("string"))) == number


def test_change_hash_spells_out_null(spark):
    expected = hashlib.md5(b"1||__NULL__||x").hexdigest()
    assert value(spark, t.change_hash([F.lit(1), F.lit(None).cast("int"), F.lit("x")])) == expected


def test_differs_tells_null_from_value(spark):
    null, one = F.lit(None).cast("int"), F.lit(1)
    assert value(spark, t.differs([null], [null])) is False
    assert value(spark, t.differs([null], [one])) is True
    assert value(spark, t.differs([one, null], [one, null])) is False
    # the text hash confuses these two pairs
    left, right = [F.lit("a||b"), F.lit("c")], [F.lit("a"), F.lit("b||c")]
    assert value(spark, t.differs(left, right)) is True
    assert value(spark, t.change_hash(left) == t.change_hash(right)) is True


def test_times(spark):
    assert value(spark, times.day_text(times.as_timestamp("2024-02-03 23:59:59"))) == "2024-02-03"
    assert value(spark, times.weekday_index(times.as_timestamp("2024-02-04"))) == 6
    aware = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)
    assert value(spark, times.as_timestamp(aware) == times.as_timestamp(datetime(2024, 1, 1, 12))) is True
    assert value(spark, times.from_epoch_seconds(F.lit(86400)).cast("string")) == "1970-01-02 00:00:00"
