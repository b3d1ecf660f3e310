from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tierkeep.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text: str) -> tuple[int, ...]:
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_counts_equal_brute_force(spark, read, edge):
    rng = random.Random(7)
    made = [(100_000 + i, "en", "".join(rng.choice("ab \n\t\x0b#é ") for _ in range(rng.randint(0, 80)))) for i in range(200)]
    docs = read("documents").select("doc_id", "lang", "text").union(spark.createDataFrame(made, "doc_id bigint, lang string, text string"))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in q.measured(docs).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts(texts[r.doc_id])
    assert q.measured(edge).count() == edge.count()


@pytest.mark.parametrize("rate", [0.005, 0.2])
def test_binomial_tail_is_exact(spark, rate):
    cases = [(n, k) for n in (0, 1, 7, 50, 400) for k in (0, 1, 3, 20) if k <= n]
    frame = spark.createDataFrame(cases, "n bigint, k bigint").withColumn("p", q.binomial_tail(F.col("n"), F.col("k"), rate))
    for n, k, p in frame.collect():
        exact = sum(math.comb(n, i) * rate**i * (1 - rate) ** (n - i) for i in range(k + 1))
        assert p == pytest.approx(1.0 if k > n * rate else exact)


def brute_joint(rows, rules, risk, allowed):
    """Cutoffs along the joint path, by exact tests on the measures of ``rows`` (two each)."""
    best, now = (None, None), [math.inf, math.inf]
    for rule, cutoff in q.path(rules):
        now[list(rules).index(rule)] = cutoff
        n, k = len(rows), sum(a > now[0] or b > now[1] for a, b in rows)
        if k > n * risk or sum(math.comb(n, i) * risk**i * (1 - risk) ** (n - i) for i in range(k + 1)) > allowed:
            break
        best = tuple(None if x == math.inf else x for x in now)
    return best


def test_certified_cutoffs_equal_brute_force(spark):
    rng = random.Random(9)
    sizes = {"en": 2000, "de": 400, "fr": 120, None: 130}
    rows = [(lang, rng.random() ** 40, rng.random() ** 20) for lang, n in sizes.items() for _ in range(n)]
    rows = [(i, *r) for i, r in enumerate(rows)]
    rules = {"a": (0.999, 0.9, 0.5, 0.1), "b": (0.999, 0.99, 0.2)}
    assert q.path(rules) == [("a", 0.999), ("b", 0.999), ("a", 0.9), ("b", 0.99), ("a", 0.5), ("a", 0.1), ("b", 0.2)]
    marks = [(i, int(rng.random() < 0.9)) for i in range(len(rows))] + [(2, 0), (None, 1), (4, None)]
    quality: dict[int, int] = {}
    for i, mark in marks:
        if i is not None and mark is not None:
            quality[i] = min(mark, quality.get(i, 1))
    measures = spark.createDataFrame([*rows, *rows[:50]], "doc_id bigint, lang string, a double, b double")
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int")
    got = {r.stratum: (r.certified_on, (r.a, r.b)) for r in q.certified_cutoffs(measures, labels, rules, 0.02, 0.05).collect()}
    good = [r for r in rows if quality.get(r[0]) == 1]
    assert q.least_good(0.02, 0.05 / 5) == 228
    for lang in ("en", "de"):
        assert got[lang] == ("own", brute_joint([r[2:] for r in good if r[1] == lang], rules, 0.02, 0.05 / 5))
    assert got["fr"] == got[None] == ("all", brute_joint([r[2:] for r in good], rules, 0.02, 0.05 / 5))
    assert all(cutoffs[0] is not None for _, cutoffs in got.values())


def test_verdicts(spark, edge, nothing):
    labels = spark.createDataFrame([(1, 1)], "doc_id bigint, quality int")
    out = q.judged(edge, labels)
    assert out.count() == edge.count() and out.where("kept and base_failed").count() == 0
    assert q.judged(nothing, labels).count() == 0
    fine = " ".join(f"w{i}" for i in range(60))
    good = spark.range(3000).selectExpr("id as doc_id", "'en' as lang", f"'{fine}' || id as text")
    bad = spark.range(5000, 5100).selectExpr("id as doc_id", "'en' as lang", f"replace('{fine}', ' ', ' # ') || id as text")
    other = bad.selectExpr("doc_id + 1000 as doc_id", "'xx' as lang", "text")
    marks = good.selectExpr("doc_id", "1 as quality")
    verdicts = q.judged(good.union(bad).union(other), marks).groupBy("kept", "failed_rules", "lang").count().collect()
    assert {(r.kept, r.failed_rules, r.lang): r["count"] for r in verdicts} == {
        (True, "", "en"): 3000, (False, "symbol_share", "en"): 100, (True, "", "xx"): 100,
    }
