from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tierkeep.llm import simhash as s
from tierkeep.llm.components import components


def plain_fingerprint(text: str) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints: list[int], ids: list) -> list:
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if ((prints[i] ^ prints[j]) & (2**64 - 1)).bit_count() <= 2:
                parent[root(i)] = root(j)
    least = {}
    for i, n in enumerate(ids):
        if n is not None:
            least[root(i)] = min(least.get(root(i), n), n)
    return [least.get(root(i)) for i in range(len(prints))]


def test_fingerprints_equal_the_definition(spark):
    texts = ["", "a", "A b", "one two three", "É\x0bÀ b c d e f", "x y z " * 50, "the cat " * 7 + "  sat"]
    for text in texts:
        assert s.fingerprint(text.encode()) & (2**64 - 1) == plain_fingerprint(text)
    word = spark.range(1).select(F.xxhash64(F.lit("a b c")).alias("h")).first().h
    assert word & (2**64 - 1) == xxhash.xxh64_intdigest(b"a b c", 42)


def test_rows_of_an_explode_are_never_broadcast(spark, tmp_path):
    """They are sized as before the explode, so a table of 100 fingerprints would be sent 34 times over."""
    spark.range(100).select(F.xxhash64("id").alias("fingerprint")).write.parquet(f"{tmp_path}/prints")
    plan = s.links(spark.read.parquet(f"{tmp_path}/prints"))._jdf.queryExecution().sparkPlan().toString()
    joins = re.findall(r"(SortMergeJoin|BroadcastHashJoin) .*?(Inner|LeftAnti|LeftSemi)", plan)
    assert [way for way, kind in joins if kind == "Inner"] == ["SortMergeJoin"], plan


@pytest.mark.parametrize("bucket", [1, 64])
def test_components_equal_brute_force(spark, bucket):
    """With a bucket of 1 nearly everything goes the way of crowded buckets."""
    rng = random.Random(4)
    prints = set()
    for _ in range(25):
        centre = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            centre ^= sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 3)))
            prints.add(int(np.uint64(centre).view(np.int64)))
    prints = sorted(prints)
    frame = spark.createDataFrame([(p,) for p in prints], "fingerprint bigint")
    got = {r.node: r.component for r in components(s.links(frame, bucket)).collect()}
    assert [got.get(p, p) for p in prints] == brute_components(prints, prints)


def test_whole_table_equals_brute_force(spark, read):
    rows = s.near_duplicates(read("documents")).collect()
    texts = {r.doc_id: r.text for r in read("documents").collect()}
    assert len(rows) == len(texts)
    prints = [plain_fingerprint(texts[r.doc_id] or "") for r in rows]
    assert [r.fingerprint & (2**64 - 1) for r in rows] == prints
    assert [r.component_id for r in rows] == brute_components(prints, [r.doc_id for r in rows])


def test_edges(spark, edge, nothing):
    rows = s.near_duplicates(edge).collect()
    assert len(rows) == edge.count()
    by = {r.doc_id: r.component_id for r in rows if r.doc_id is not None}
    assert by == {1: 1, 2: 1, 3: 3, 4: 3, 7: 7, 8: 3}
    kept = s.without_copies(edge)
    assert kept.columns == edge.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3, 7]
    assert s.near_duplicates(nothing).count() == 0 and s.without_copies(nothing).count() == 0
    assert s.hex_digits(F.lit(-1)) is not None
    assert spark.range(1).select(s.hex_digits(F.lit(26).cast("bigint")).alias("h")).first().h == "000000000000001a"


def test_components_of_a_long_path_and_a_large_star(spark):
    path = spark.range(1, 200).selectExpr("id as a", "id + 1 as b")
    star = spark.range(1, 3000).selectExpr("1000L as a", "1000 + id as b")
    got = components(path.union(star).union(spark.sql("select 5L a, 5L b union all select null, 7L")))
    counts = {r.component: r["count"] for r in got.groupBy("component").count().collect()}
    assert counts == {1: 200, 1000: 3000}
    assert got.count() == got.select("node").distinct().count()
