from __future__ import annotations

from pyspark.sql import functions as F

from tierkeep.operators.facts import append_counts, known, unseen
from tierkeep.operators.updates import changed_between, refresh_values, update_matched, update_where


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_unseen_and_known(spark):
    source = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, batch string")
    stored = spark.createDataFrame([("a",), ("a",), ("z",)], "batch string")
    assert rows_of(unseen(source, stored, "batch").select("id")) == [(3,)]
    assert rows_of(known(source, stored, "batch").select("id")) == [(1,), (2,)]
    assert append_counts(source, stored, "batch").first().asDict() == {"processed": 3, "inserted": 1, "updated": 0, "unchanged": 2}
    assert append_counts(source, None, "batch").first()["inserted"] == 3
    assert append_counts(source.filter("false"), stored, "batch").first()["processed"] == 0


def test_update_matched(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (None, "c", 3)], "k int, name string, v int")
    updates = spark.createDataFrame([(1, 9), (2, None), (7, 7)], "k int, v int")
    assert rows_of(update_matched(target, updates, "k", ["v"])) == [(1, "a", 9), (2, "b", None), (None, "c", 3)]


def test_update_where_leaves_null_conditions_alone(spark):
    rows = spark.createDataFrame([(1, 5), (2, None), (3, 1)], "k int, v int")
    changed = update_where(rows, F.col("v") > 2, {"v": F.lit(0)})
    assert rows_of(changed) == [(1, 0), (2, None), (3, 1)]


def test_refresh_values_keeps_old_without_fresh(spark):
    target = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "k int, v int")
    fresh = spark.createDataFrame([(1, 11), (2, None)], "k int, v int")
    assert rows_of(refresh_values(target, fresh, "k", "v")) == [(1, 11), (2, 20), (3, None)]


def test_changed_between(spark):
    old = spark.createDataFrame([(1, "low"), (2, "high"), (3, "low")], "k int, p string")
    new = spark.createDataFrame([(1, "high"), (2, "high"), (4, "low")], "k int, p string")
    assert rows_of(changed_between(old, new, "k", "p")) == [(1, "low", "high")]
