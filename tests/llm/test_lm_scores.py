from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tierkeep.llm import lm_scores, recurrent
from tierkeep.llm.queries import QUERIES


def plain(rows):
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score by the definition."""
    split = []
    for doc_id, text in rows:
        name = "" if doc_id is None else str(doc_id)
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for space in "\t\n\x0b\x0c\r":
            lower = lower.replace(space, " ")
        split.append((doc_id, zlib.crc32(name.encode()) % 7 == 2, [*(w for w in lower.split(" ") if w), None]))
    counts = Counter(t for _, held, tokens in split if not held for t in tokens)
    n, v = sum(counts.values()), len(counts)
    return [
        (i, held, len(t), sum(w in counts for w in t), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t))
        for i, held, t in split
    ]


def same(got, want):
    got, want = sorted(got, key=str), sorted(want, key=str)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert all(a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-9) for a, b in zip(got, want))


def test_base_columns_and_better_scores(spark, read, sf_dir):
    rows = QUERIES["op11_recurrent_scores"](spark, sf_dir).collect()
    same([tuple(r)[:6] for r in rows], plain([(r.doc_id, r.text) for r in read("documents").collect()]))
    for held in (False, True):
        mine = [r for r in rows if r.held_out == held]
        assert sum(r.score for r in mine) > sum(r.base_score for r in mine)


def test_words_outside_the_known_ones_come_by_the_join(spark, read, monkeypatch):
    docs = read("documents").limit(80).cache()
    want = {r.doc_id: r for r in lm_scores.scored(docs).collect()}
    monkeypatch.setattr(lm_scores, "KNOWN", 3000)
    got = lm_scores.scored(docs).collect()
    same([tuple(r)[:6] for r in got], plain([(r.doc_id, r.text) for r in docs.collect()]))
    assert all(r.score == pytest.approx(want[r.doc_id].score, rel=1e-5) for r in got)


def one_by_one(model, ids):
    """The document's log-likelihood, a token at a time."""
    w = {n: x.astype(np.float64) for n, x in model.weights.items()}
    h, total, size = np.zeros(model.hidden), 0.0, model.hidden
    logistic = lambda x: 1 / (1 + np.exp(-x))
    for token in ids:
        k = int(model.class_of[token])
        low, high = model.bounds[k], model.bounds[k + 1]
        for logits, at in ((h @ w["classes"] + w["class_bias"], k), (w["outputs"][low:high] @ h + w["output_bias"][low:high], token - low)):
            total += logits[at] - np.log(np.exp(logits).sum()) if len(logits) > 1 else 0.0
        g, m = w["inputs"][token], h @ w["state"]
        z, r = logistic(g[:size] + m[:size]), logistic(g[size : 2 * size] + m[size : 2 * size])
        h = z * h + (1 - z) * np.tanh(g[2 * size :] + r * m[2 * size :])
    return total


def test_state_is_carried_over_windows_and_cleared_between_documents():
    rng = np.random.default_rng(3)
    model = recurrent.Model.fresh(np.array([50, *range(40, 0, -1)]), hidden=5, classes=6)
    model = model.filled(model.flat() + rng.normal(0, 0.3, len(model.flat())))
    docs = [rng.integers(0, 41, n).astype(np.uint16) for n in (1, 2, 15, 16, 17, 100, 333, 40, 0, 7)]
    assert model.log_likelihoods(docs) == pytest.approx([one_by_one(model, d) for d in docs], rel=1e-4)
    assert list(model.log_likelihoods([])) == []


def test_probabilities_add_up_to_one():
    model = recurrent.Model.fresh(np.array([50, *range(40, 0, -1)]), hidden=5, classes=6)
    model = model.filled(model.flat() + np.random.default_rng(1).normal(0, 0.3, len(model.flat())))
    start = np.array([3, 17, 0, 40], np.uint16)
    whole = model.log_likelihoods([start])[0]
    onward = model.log_likelihoods([np.append(start, np.uint16(t)) for t in range(41)])
    assert np.exp(onward - whole).sum() == pytest.approx(1, abs=1e-4)


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(8)
    model = recurrent.Model.fresh(np.array([9, *range(12, 0, -1)]), hidden=4, classes=4)
    model = model.filled(model.flat() + rng.normal(0, 0.4, len(model.flat())))
    lanes = recurrent.Lanes([rng.integers(0, 13, n).astype(np.uint16) for n in (6, 3, 9)])
    places, real, first = next(lanes.windows(9))
    tokens = lanes.flat[places]

    def loss(m):
        run = recurrent._Run(m, tokens, first, np.zeros((4, places.shape[1]), np.float32), keep=True)
        return run, *run.predict(tokens, real, learn=True)

    run, logs, grads = loss(model)
    drives, grads["state"] = run.back(grads.pop("_states"))
    grads["inputs"] = np.zeros_like(model.weights["inputs"])
    np.add.at(grads["inputs"], tokens.ravel(), drives.T)
    flat = np.concatenate([grads[n].ravel() for n in recurrent.PARTS])
    for at in rng.choice(len(flat), 60, replace=False):
        step = np.zeros(len(flat))
        step[at] = 0.02
        up, down = (loss(model.filled(model.flat() + s))[1].astype(np.float64).sum() for s in (step, -step))
        assert flat[at] == pytest.approx((down - up) / 0.04, abs=5e-3)


def test_learning_finds_an_order_that_counts_do_not_have():
    rng = np.random.default_rng(0)
    docs = [np.concatenate([np.tile(np.array([1, 2, 3, 4], np.uint16), 30)[rng.integers(4) :]]) for _ in range(300)]
    model = recurrent.Model.fresh(np.array([0, 25, 25, 25, 25]))
    before = model.log_likelihoods(docs[:20]).sum()
    learner = recurrent.Learner(model)
    for _ in range(10):
        learner.learn(docs)
    assert learner.model.log_likelihoods(docs[:20]).sum() > before / 4


def test_edges(spark, edge, nothing):
    got = lm_scores.scored(edge).collect()
    same([tuple(r)[:6] for r in got], plain([(r.doc_id, r.text) for r in edge.collect()]))
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)
    assert lm_scores.scored(nothing).count() == 0
    held = spark.createDataFrame([(i, "some words") for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2], "doc_id long, text string")
    alone = lm_scores.scored(held).collect()
    same([tuple(r)[:6] for r in alone], plain([(r.doc_id, "some words") for r in held.collect()]))
    assert all(math.isfinite(r.score) for r in alone)
