from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

from tierkeep.llm import spelling
from tierkeep.llm.queries import QUERIES


def brute_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(counts):
    by_gap = defaultdict(set)  # words one edit apart agree up to, or from, their middle
    for w in counts:
        by_gap[w[:3]].add(w)
        by_gap[":" + w[-3:]].add(w)
    near = {w: {o for k in (w[:3], ":" + w[-3:]) for o in by_gap[k] if one_edit(w, o)} for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None
    rows = set()
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return rows


def found(frame):
    return [(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in frame.collect()]


def test_query_equals_brute_force(spark, read, sf_dir):
    counts = brute_words([(r.doc_id, r.text) for r in read("documents").collect()])
    rows = found(QUERIES["op13_spelling_variants"](spark, sf_dir))
    assert len(rows) == len(counts) and set(rows) == brute_variants(counts)
    assert sum(r[1] is not None for r in rows) > 5


def all_pairs(words):
    return sorted((a, b) for a in words for b in words if one_edit(a, b))


def test_near_words_of_few_letters(spark):
    rng = random.Random(4)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 7))) for _ in range(400)}
    words |= {"a" * n for n in (7, 8, 9, 30, 31, 33)}
    words |= {"x" * 300 + "y" * 300, "x" * 299 + "y" * 300, "x" * 300 + "y" * 301, "x" * 300 + "z" + "y" * 299}
    got = spelling.near_words(spark.createDataFrame([(w,) for w in sorted(words)], "word string"))
    assert sorted(map(tuple, got.collect())) == all_pairs(words)


def test_one_beginning_shared_by_all(spark):
    words = ["same" * 3 + f"{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    got = spelling.near_words(spark.createDataFrame([(w,) for w in words], "word string"))
    assert sorted(map(tuple, got.collect())) == all_pairs(words)


def test_chains_lead_to_the_root(spark):
    texts = ["lantern " * 400, "lanterm " * 30, "lantermm " * 3, "lanternn " * 2, "kerosene " * 2]
    rows = {r[0]: r for r in found(spelling.variants(spark.createDataFrame(list(enumerate(texts, 4)), "doc_id long, text string")))}
    assert rows["lantermm"][1:3] == ("lanterm", "lantern") and rows["lanterm"][1:3] == ("lantern", "lantern")
    assert rows["kerosene"][1:] == (None, "kerosene", 2, 0, None)


def test_edges(spark, edge, nothing):
    rows = [(None if r.doc_id is None else r.doc_id, r.text) for r in edge.collect()]
    assert set(found(spelling.variants(edge))) == brute_variants(brute_words(rows))
    assert spelling.variants(nothing).count() == 0
    long = "q" * 5000
    pair = spark.createDataFrame([(1, f"{long} {long} {long}q {long}q")], "doc_id long, text string")
    assert {(r[0], r[4]) for r in found(spelling.variants(pair))} == brute_near(brute_words([(1, f"{long} {long} {long}q {long}q")]))


def brute_near(counts):
    return {(w, sum(one_edit(w, o) for o in counts)) for w in counts}
