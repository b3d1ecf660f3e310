from __future__ import annotations

import zlib

import numpy as np

from tierkeep.llm import quality_model as q
from tierkeep.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = QUERIES["op2_additive_quality"](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    judged = [r.predicted == labels[r.doc_id] for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean(judged) >= 0.93


def test_tables_add_up_and_learn_an_interaction():
    rng = np.random.default_rng(0)
    rows = rng.random((4000, 3))
    labels = ((rows[:, 0] > 0.5) ^ (rows[:, 1] > 0.5)).astype(float)
    model = q.fit(rows, labels)
    assert (0, 1) in model.pairs
    assert ((model.scores(rows) > 0.5) == labels).mean() > 0.95
    at = model.bins(rows[:1])[0]
    by_hand = model.base + sum(t[at[f]] for f, t in enumerate(model.tables))
    by_hand += sum(t[at[f], at[g]] for (f, g), t in zip(model.pairs, model.pair_tables))
    assert np.isclose(by_hand, model.margins(rows[:1])[0])


def test_constant_without_contrast():
    assert np.allclose(q.fit(np.empty((0, 2)), np.empty(0)).scores(np.zeros((1, 2))), 0.5)
    assert q.fit(np.ones((9, 2)), np.ones(9)).scores(np.zeros((1, 2)))[0] > 0.5


def test_edges(spark, edge, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 1), (4, None, 0), (7, 0, 0)], "doc_id bigint, quality int, toxic int")
    model = q.learn(edge, labels)
    assert q.with_score(edge, model).where("score between 0 and 1").count() == edge.count()
    assert q.accepted(edge, model, 0.0).columns == edge.columns
    assert q.accepted(edge, model, 0.0).count() == edge.count()
    assert q.with_score(nothing, q.learn(nothing, labels)).count() == 0
    assert q.with_score(edge, q.learn(edge, labels.limit(0))).count() == edge.count()


def test_sample_is_bounded(spark, read, monkeypatch):
    seen = []
    monkeypatch.setattr(q, "fit", lambda rows, labels, **o: seen.append(len(rows)))
    q.learn(read("documents"), read("labels"), sample=20)
    assert seen == [20]
