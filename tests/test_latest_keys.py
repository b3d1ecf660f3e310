from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tierkeep.operators.envelope import batched
from tierkeep.operators.keys import assign_chunks, dense_index
from tierkeep.operators.latest import latest_partition, latest_per_key


def test_latest_per_key_breaks_ties(spark):
    rows = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "z"), (2, 1, "c")], "k int, t int, v string")
    newest = latest_per_key(rows, ["k"], [F.desc("t"), F.desc("v")])
    assert {tuple(r) for r in newest.collect()} == {(1, 5, "b"), (2, 1, "c")}


def test_latest_per_key_cuts_down_before_the_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = latest_per_key(rows, ["k"], [F.desc("id")])._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[shuffle:], "no partial limit below the shuffle"


def test_latest_partition(spark):
    rows = spark.createDataFrame([("2024-01-01", 1, 9), ("2024-01-02", 1, 3), ("2024-01-02", 1, 4), ("2024-01-02", 2, 1)], "d string, k int, v int")
    assert latest_partition(rows, F.col("d")).count() == 3
    newest = latest_partition(rows, F.col("d"), ["k"], [F.desc("v")])
    assert {tuple(r) for r in newest.collect()} == {("2024-01-02", 1, 4), ("2024-01-02", 2, 1)}
    assert latest_partition(rows.filter("false"), F.col("d"), ["k"], [F.desc("v")]).count() == 0


def test_latest_partition_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "fact")
    spark.range(100).withColumn("d", F.concat(F.lit("2024-01-0"), (F.col("id") % 5).cast("string"))).write.partitionBy("d").parquet(path)
    newest = latest_partition(spark.read.parquet(path), F.col("d"))
    assert newest.count() == 20
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan and "Subquery" in plan


@pytest.mark.parametrize("rows", [0, 1, 7, 500])
def test_dense_index(spark, rows):
    frame = spark.range(rows).select((F.col("id") * 7919 % 1009).alias("k"), "id")
    numbered = dense_index(frame, [F.col("k"), F.col("id")], "n", start=11).collect()
    by_order = sorted(numbered, key=lambda r: (r["k"], r["id"]))
    assert [r["n"] for r in by_order] == list(range(11, 11 + rows))


def test_dense_index_with_one_dominant_key(spark):
    frame = spark.range(900).select(F.when(F.col("id") < 600, 1).otherwise(F.col("id")).alias("k"), "id")
    numbered = dense_index(frame, [F.col("k"), F.col("id")], "n", partitions=4)
    assert sorted(r["n"] for r in numbered.collect()) == list(range(900))
    sizes = [r["n"] for r in numbered.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 600, "the dominant key was not split over tasks"


def test_chunks_and_batches_are_bounded(spark):
    chunks = assign_chunks(spark.range(250), [F.col("id")], 100).groupBy("chunk").count().collect()
    assert {r["chunk"]: r["count"] for r in chunks} == {0: 100, 1: 100, 2: 50}
    frame = spark.range(330).withColumn("run", F.when(F.col("id") < 130, "a").otherwise("b"))
    sizes = batched(frame, [F.col("id")], "run").groupBy("_batch", "run").count().collect()
    assert max(r["count"] for r in sizes) <= 100
    assert sum(r["count"] for r in sizes) == 330
    assert len({r["_batch"] for r in sizes}) == len(sizes)
