from __future__ import annotations

import pytest

from tests.compare import connect, differences
from tierkeep.llm import mixing
from tierkeep.llm.queries import ORACLES, QUERIES


def reshared(sizes, weights, share=1.5, cap=2.0):
    """Targets by resharing the excess again and again."""
    total, stopped = share * sum(sizes), set()
    while True:
        left = total - sum(cap * sizes[i] for i in stopped)
        weight = sum(w for i, w in enumerate(weights) if i not in stopped)
        targets = [cap * s if i in stopped else left * weights[i] / weight for i, s in enumerate(sizes)]
        over = {i for i, t in enumerate(targets) if t > cap * sizes[i] * (1 + 1e-12)}
        if not over:
            return targets
        stopped |= over


@pytest.mark.parametrize("sizes", [[100, 100, 100], [10, 500, 30, 7, 7, 900], [1, 2, 3, 1000], [5], [0, 10, 10, 0]])
def test_targets_equal_resharing(spark, sizes):
    frame = spark.createDataFrame([(f"s{i:02}", n) for i, n in enumerate(sizes)], "source string, size bigint")
    got = [r.target for r in mixing.source_targets(frame).orderBy("source").collect()]
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    assert got == pytest.approx(reshared(sizes, weights))


def test_equals_sql(spark, sf_dir):
    name = "op6_systematic_mix"
    assert differences(QUERIES[name](spark, sf_dir), ORACLES[name], connect(sf_dir)) == []


def test_near_targets_and_the_same_again(spark, sf_dir):
    taken = QUERIES["op6_systematic_mix"](spark, sf_dir)
    assert taken.where("taken > 2 * size").count() == 0
    sums = taken.groupBy("source_size", "target").agg({"taken": "sum", "size": "max"})
    assert sums.where("abs(`sum(taken)` - target) > `max(size)` + 1e-6").count() == 0
    assert sorted(taken.collect()) == sorted(QUERIES["op6_systematic_mix"](spark, sf_dir).collect())


def test_edges(spark, edge, nothing):
    counted = mixing.with_copies(edge.select("doc_id", "text", "source"))
    assert counted.count() == edge.count()
    copies = sum(r._copies for r in counted.collect())
    out = mixing.mixed(edge)
    assert out.columns == edge.columns and out.count() == copies
    assert mixing.mixed(nothing).count() == 0
