from __future__ import annotations

import corpus_pipeline
from tests.llm.test_decontaminate import brute_tiles
from tests.llm.test_near_copies import brute_kept
from tierkeep.llm import decontaminate, quality_model
from tierkeep.llm.mixing import with_copies
from tierkeep.session import cut


def test_every_stage_against_its_definition(spark, read, sf_dir):
    docs = read("documents").where("n_chars < 3000").withColumnRenamed("n_chars", "n_chars")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        kept[name] = docs
        docs = cut(stage(spark, docs, sf_dir))
        assert name == "sharding" or docs.columns == columns

    def ids(frame):
        return sorted(r.doc_id for r in frame.select("doc_id").collect())

    model = quality_model.learn(kept["quality_classifier"], read("labels"))
    scored = quality_model.with_score(kept["quality_classifier"], model)
    assert ids(kept["simhash_near_dedup"]) == ids(scored.where("score >= 0.3"))
    rows = [(r.doc_id, r.text) for r in kept["simhash_near_dedup"].collect()]
    assert ids(kept["benchmark_decontamination"]) == brute_kept(rows)
    tests = [decontaminate.words_of((r.text or "").encode()) for r in read("benchmark").collect()]

    def clean(text):
        words = decontaminate.words_of((text or "").encode())
        seen = set(words)
        return all(sum(w in seen for w in t) < 0.6 * len(t) or brute_tiles(words, t, 5) < 0.6 * len(t) for t in tests)

    assert ids(kept["source_mixing"]) == sorted(r.doc_id for r in kept["benchmark_decontamination"].collect() if clean(r.text))
    copies = {r.doc_id: r._copies for r in with_copies(kept["source_mixing"]).collect()}
    assert ids(kept["sharding"]) == sorted(i for i, n in copies.items() for _ in range(n))
    assert ids(docs) == ids(kept["sharding"])
    for shard in docs.select("shard").distinct().collect():
        slots = sorted(r.slot for r in docs.where(docs.shard == shard.shard).collect())
        assert slots == list(range(len(slots)))


def test_run(spark, sf_dir):
    first = corpus_pipeline.run(spark, sf_dir)
    assert first.count() > 0
    assert sorted(map(str, first.collect())) == sorted(map(str, corpus_pipeline.run(spark, sf_dir).collect()))


def test_edges(spark, edge, nothing, sf_dir):
    for frame in (edge, nothing):
        docs = frame
        for name, stage in corpus_pipeline.STAGES[1:]:
            docs = cut(stage(spark, docs.withColumnRenamed("a.b", "a_b"), sf_dir))
    assert docs.count() == 0
