from __future__ import annotations

import random

from tierkeep.llm import decontaminate as d


def brute_tiles(text, test, least):
    """Greedy string tiling from its definition: the longest match of unmarked words first."""
    free_text, free_test, covered = [True] * len(text), [True] * len(test), 0
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(text)):
            for j in range(len(test)):
                n = 0
                while (
                    i + n < len(text) and j + n < len(test) and text[i + n] == test[j + n] and free_text[i + n] and free_test[j + n]
                ):
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return covered
        covered += n
        free_text[i : i + n] = [False] * n
        free_test[j : j + n] = [False] * n


def test_tiles_equal_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        text = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 25))]
        test = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 14))]
        got = d.tiles(text, test, 3)
        assert sum(n for *_, n in got) == brute_tiles(text, test, 3)
        assert all(text[i : i + n] == test[j : j + n] for i, j, n in got)
        assert len({j + k for _, j, n in got for k in range(n)}) == sum(n for *_, n in got)


def test_reordered_passage():
    words = [f"w{i}".encode() for i in range(30)]
    text = [b"x"] + words[20:] + [b"y"] + words[:10] + [b"z"] + words[10:20]
    assert sorted(n for *_, n in d.tiles(text, words)) == [10, 10, 10]


def test_contamination_equals_brute_force(spark, read):
    benchmark = read("benchmark")
    tests = {r.item_id: d.words_of((r.text or "").encode()) for r in benchmark.collect()}
    docs = read("documents").where("n_chars < 1500")
    texts = {r.doc_id: d.words_of((r.text or "").encode()) for r in docs.collect()}
    for row in d.contamination(docs, benchmark).collect():
        text = texts[row.doc_id]
        seeds = {tuple(text[i : i + 5]) for i in range(len(text) - 4)}
        hits = [
            item
            for item, test in tests.items()
            if any(tuple(test[j : j + 5]) in seeds for j in range(len(test) - 4))
            and brute_tiles(text, test, 5) >= 0.6 * len(test)
        ]
        assert row.item_ids == sorted(hits) and row.contaminated == bool(hits) and row.n_items == len(hits)


def test_edges(spark, edge, nothing):
    benchmark = spark.createDataFrame(
        [(1, "quick brown fox jumps over the lazy dog"), (1, "quick brown fox jumps over the lazy dog"), (2, None), (3, ""),
         (4, "wort wort wort wort wort wort"), (None, "fox jumps over the lazy dog"), (5, "wort")],
        "item_id bigint, text string",
    )
    found = d.contamination(edge, benchmark).collect()
    assert len(found) == edge.count()
    by = {r.doc_id: r for r in found if r.doc_id is not None}
    assert by[1].item_ids == [1] and by[1].n_items == 3 and by[7].item_ids == [4, 5]
    assert not by[3].contaminated and not by[4].contaminated
    kept = d.decontaminated(edge, benchmark)
    assert kept.columns == edge.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 3, 4, 8]
    assert d.contamination(nothing, benchmark).count() == 0
    assert d.contamination(edge, benchmark.limit(0)).where("contaminated").count() == 0


def test_a_passage_in_very_many_documents(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    docs = spark.range(3000).selectExpr("id as doc_id", f"concat('a', id, ' {passage}') as text")
    benchmark = spark.createDataFrame([(9, passage)], "item_id bigint, text string")
    assert d.contamination(docs, benchmark).where("contaminated and item_ids = array(9L)").count() == 3000


def test_short_tests_match_as_a_whole(spark):
    docs = spark.createDataFrame([(1, "x alpha beta gamma y"), (2, "alpha beta y gamma"), (3, "a 中文測試 b"), (4, "gamma")], "doc_id bigint, text string")
    benchmark = spark.createDataFrame([(1, "Alpha beta, gamma"), (2, "中文測試"), (3, "?")], "item_id bigint, text string")
    assert {r.doc_id: r.item_ids for r in d.contamination(docs, benchmark).collect()} == {1: [1], 2: [], 3: [2], 4: []}
    assert [r.doc_id for r in d.decontaminated(docs, benchmark).orderBy("doc_id").collect()] == [2, 4]


def test_a_common_opening_moves_no_text(spark):
    opening = "which of the following is true of"
    docs = spark.range(400).selectExpr("id as doc_id", f"concat('{opening} d', id, ' e', id) as text")
    docs = docs.union(spark.createDataFrame([(1000, f"{opening} " + " ".join(f"t7w{i}" for i in range(20)))], "doc_id bigint, text string"))
    tests = [(n, f"{opening} " + " ".join(f"t{n}w{i}" for i in range(20))) for n in range(50)]
    benchmark = spark.createDataFrame(tests, "item_id bigint, text string")
    assert d.matches(docs, benchmark).count() == 401 * 50
    assert [(r.item_id, r.matched_words) for r in d.matches(docs, benchmark, d.COVERAGE).collect()] == [(7, 27)]
    assert d.decontaminated(docs, benchmark).count() == 400
