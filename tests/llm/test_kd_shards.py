from __future__ import annotations

import zlib

import pytest
from pyspark.sql import functions as F

from tierkeep.llm import kd_shards
from tierkeep.llm.ordering import ranked
from tierkeep.llm.queries import QUERIES


def test_law_on_the_whole_table(spark, read, sf_dir):
    rows = QUERIES["op5_kd_shards"](spark, sf_dir).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in read("documents").collect()}
    assert len(rows) == len(texts) and {r.law for r in rows} == {"bytes"}
    assert all(r.size == len(texts[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id]) for r in rows)
    shards = {s: [r for r in rows if r.shard == s] for s in range(8)}
    assert all(sorted(r.slot for r in members) == list(range(len(members))) for members in shards.values())
    sums = [sum(r.size for r in members) for members in shards.values()]
    assert max(sums) - min(sums) <= 3 * max(r.size for r in rows)


def test_equal_values_are_split(spark):
    """All rows in one bin of every dimension: ties decide, and the law still holds."""
    docs = spark.range(8000).selectExpr("5L as doc_id", "cast(id as string) as text", "'s' as source", "'en' as lang")
    sums = [r.n for r in kd_shards.sharded(docs).groupBy("shard").agg(F.sum("size").alias("n")).collect()]
    assert len(sums) == 8 and max(sums) / min(sums) < 1.02


def test_a_third_of_the_bytes_in_one_bin(spark):
    docs = spark.range(9000).selectExpr("id as doc_id", "if(id % 3 = 0, 'same text', repeat('x', cast(id % 50 as int))) as text", "'s' as source", "'en' as lang")
    sums = [r.n for r in kd_shards.sharded(docs).groupBy("shard").agg(F.sum("size").alias("n")).collect()]
    assert len(sums) == 8 and max(sums) / min(sums) < 1.02


def test_splits_until_the_target(spark):
    rows = spark.range(1000).selectExpr("id", "cast(id as double) as x", "cast(id % 7 + 1 as bigint) as w")
    leaves = kd_shards.kd_nodes(rows, {"x": F.col("x")}, F.col("w"), F.xxhash64("id"), target=500)
    sums = leaves.groupBy("_node").agg(F.sum("w").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("*").alias("c"))
    found = sums.collect()
    assert all(r.n <= 500 and r.n >= 200 for r in found)
    assert all(r.hi - r.lo + 1 == r.c for r in found)  # ranges of the one dimension
    with pytest.raises(ValueError):
        kd_shards.kd_nodes(rows, {"x": F.col("x")}, F.col("w"), F.xxhash64("id"))


def test_edges(spark, edge, nothing):
    out = kd_shards.sharded(edge)
    assert out.columns == [c for c in edge.columns if c != "size"] + ["size", "shard", "slot"]
    assert out.count() == edge.count() and out.where("shard between 0 and 7").count() == edge.count()
    assert kd_shards.sharded(nothing).count() == 0


def test_ranks_within_groups(spark):
    rows = spark.range(1000).selectExpr("if(id % 3 = 0, null, 'g' || (id % 2)) as g", "id % 100 as v", "id")
    for group in {r.g for r in rows.collect()}:
        own = ranked(rows, ["g"], ["v", "id"], "n").where(F.col("g").eqNullSafe(F.lit(group))).collect()
        assert [r.n for r in sorted(own, key=lambda r: (r.v, r.id))] == list(range(1, len(own) + 1))
