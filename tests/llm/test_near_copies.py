from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_simhash import brute_components
from tierkeep.llm import near_copies as n
from tierkeep.llm import simhash


def plain_shingles(text):
    words = simhash.words_of((text or "").encode())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_kept(rows):
    """The smallest id of every group, by comparing all pairs."""
    sets, parent = [plain_shingles(text) for _, text in rows], list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if 5 * min(len(sets[i]), len(sets[j])) >= 4 * max(len(sets[i]), len(sets[j])):
                if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                    parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted(least.values())


def made_texts():
    rng, texts = random.Random(6), []
    line = " ".join(f"common{i}" for i in range(12))
    for size in (2, 5, 6, 9, 14, 30, 60, 200, 450):
        for _ in range(4):
            words = [f"w{rng.randrange(10**6)}" for _ in range(size)] + (line.split() if rng.random() < 0.4 else [])
            for _ in range(7):
                copy = list(words)
                for _ in range(rng.randint(0, max(1, size // 40))):
                    copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
                texts.append(" ".join(copy[rng.randint(0, 2) :] + [f"y{i}" for i in range(rng.randint(0, size // 12))]))
    return texts


def test_shingles_are_told_apart_like_tuples_of_words():
    for text in [*made_texts(), "", "a", "a b c", "c b a", "a a a a a a a a"]:
        assert len(n.shingles(text.encode())) == len(plain_shingles(text))
    a, b = ("one two three four five six".encode(), "zero one two three four five".encode())
    assert len(np.intersect1d(n.shingles(a), n.shingles(b))) == 1
    assert not len(np.intersect1d(n.shingles(b"a b"), n.shingles(b"b a")))


def test_chance_that_near_copies_share_a_key():
    rng = np.random.default_rng(3)
    missed, met = 0, 0
    for size in (36, 90, 450):
        for _ in range(700):
            pool = rng.integers(0, 2**63, 2 * size).astype(np.uint64)
            apart = size // 9  # of each: 8/9 shared of 10/9, exactly 0.8
            a, b = np.sort(pool[:size]), np.sort(pool[apart : size + apart])
            missed += not np.isin(n.keys(a), n.keys(b)).any()
            met += np.isin(n.keys(a), n.keys(np.sort(pool[size // 2 : size + size // 2]))).any()
    assert missed <= 2 and met < 0.2 * 2100


def template_pages(pages, own=8):
    """Pages of one template, no two of them near copies, and a near copy of every fiftieth."""
    head, texts = " ".join(f"t{i}" for i in range(44)), []
    for i in range(pages):
        words = [f"p{i}w{j}" for j in range(own)]
        texts.append(f"{head} {' '.join(words)}")
        if i % 50 == 0:
            texts.append(f"{head} {' '.join(words[:-1])} other{i}")
    return texts


def test_pages_of_a_template_are_not_compared_all_with_all(spark):
    rows = list(enumerate(template_pages(600)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    crowd = n._known(docs).select("print", "n", F.col("print").alias("part"), "doc_id")
    pairs = n._by_rarest(crowd.drop("doc_id"), crowd, docs)
    assert pairs.count() <= 2 * len(rows)
    assert sorted(r.doc_id for r in n.without_near_copies(docs).collect()) == brute_kept(rows)


def copies_of_one_text(copies=500, size=150):
    """Copies of one text with a few other words each; hardly any two are near copies, and those are compared with all others."""
    rng = random.Random(11)
    base, texts = [f"b{i}" for i in range(size)], []
    for i in range(copies):
        words = list(base)
        for at in rng.sample(range(size), rng.randint(2, 8)):
            words[at] = f"c{i}at{at}"
        texts.append(" ".join(words))
    return texts


def test_sketches_differ_in_no_more_bits_than_sets_in_shingles():
    sets = [n.shingles(t.encode()) for t in [*made_texts(), *copies_of_one_text(40), ""]]
    sketches = [np.unpackbits(n.sketch(s).view(np.uint8)) for s in sets]
    assert all(len(s) == n.BITS for s in sketches)
    for i in range(0, len(sets), 3):
        for j in range(i):
            apart = len(np.setxor1d(sets[i], sets[j], assume_unique=True))
            bits = int((sketches[i] != sketches[j]).sum())
            assert bits <= apart and (apart - bits) % 2 == 0


def test_copies_too_far_apart_are_not_paired_and_no_near_copies_lost(spark):
    rows = list(enumerate(copies_of_one_text()))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    crowd = n._known(docs).select("print", "n", F.col("print").alias("part"), "doc_id")
    sets = {n._print(s): s for s in (n.shingles(t.encode()) for _, t in rows)}
    near, names = set(), sorted(sets)
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            common = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            if 5 * common >= 4 * (len(sets[a]) + len(sets[b]) - common):
                near.add((a, b))
    pairs = {(r.a, r.b) for r in n._by_rarest(crowd.drop("doc_id"), crowd, docs).collect()}
    assert near <= pairs and len(near) > 100
    assert len(pairs) <= 2 * len(near)
    assert sorted(r.doc_id for r in n.without_near_copies(docs).collect()) == brute_kept(rows)


def test_crowded_keys_give_the_same_documents(spark, monkeypatch):
    rows = list(enumerate(made_texts()))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(n.links, "__defaults__", (1,))
    assert sorted(r.doc_id for r in n.without_near_copies(docs).collect()) == brute_kept(rows)


def test_kept_documents_equal_brute_force(spark):
    texts = made_texts()
    rows = list(enumerate(texts))
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = n.without_near_copies(docs)
    assert sorted(r.doc_id for r in kept.collect()) == brute_kept(rows)


def test_the_stage_finds_near_copies_far_beyond_two_bits(spark, read, sf_dir):
    docs = read("documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    prints = [simhash.fingerprint((t or "").encode()) for _, t in rows]
    want = brute_kept(rows)
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect()) == want
    assert len(want) < len(set(brute_components(prints, [i for i, _ in rows])))


def test_edges(edge, nothing):
    kept = n.without_near_copies(edge)
    assert kept.columns == edge.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3, 7]
    assert n.without_near_copies(nothing).count() == 0
