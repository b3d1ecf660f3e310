from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from tierkeep.llm import bit_planes as b


def test_dot_products_are_exact():
    rng = np.random.default_rng(5)
    for low, high in ((0, 1), (-1, 1), (-8, 8), (-1000, 37), (-(1 << 26), 1 << 26)):
        x, c = rng.integers(low, high, (50, 64)), rng.integers(low, high, (6, 64))
        planes = b.planes_needed(low, high)
        got = b.dot_products(b.packed_planes(x, planes), b.packed_planes(c, planes), planes)
        assert (got == x @ c.T).all()


def brute(rows, rounds=10, k=8):
    kept = [(i, [math.floor(x * 1024) for x in e]) for i, e in rows
            if e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]

    def near(v):
        return min(((sum((a - c) ** 2 for a, c in zip(v, m)), j) for j, m in enumerate(centroids)), default=None)

    for _ in range(rounds):
        mine = [[] for _ in centroids]
        for _, v in kept:
            mine[near(v)[1]].append(v)
        centroids = [[sum(x) // len(own) for x in zip(*own)] if own else c for own, c in zip(mine, centroids)]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    sums = {j: sum(d for _, c, d in found if c == j) for j in range(k)}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, sums[c], sum(sums.values()), names[c]) for i, c, d in found), key=str)


def test_odd_vectors_ties_and_extra_columns(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(0, 0.4, 64)]) for i in range(60)]
    rows += [(5, rows[5][1]), (None, rows[7][1]), (None, [0.0] * 64), (61, [-0.0004] * 64), (62, rows[9][1]), (63, rows[9][1])]
    rows += [(70, None), (71, []), (72, [1.0] * 63), (73, [1.0] * 63 + [None]), (74, [1.0] * 63 + [math.nan]), (75, [math.inf] + [0.0] * 63)]
    frame = spark.createDataFrame([(i, e, "x", 1) for i, e in rows], "vec_id long, embedding array<double>, cluster string, row int")
    got = sorted((tuple(r) for r in b.clustered(frame).collect()), key=str)
    assert got == brute(rows)
    assert b.clustered(frame.where("vec_id >= 70")).count() == 0
    few = frame.where("vec_id in (1, 2, 3)")
    assert sorted((tuple(r) for r in b.clustered(few).collect()), key=str) == brute(rows[1:4])


def test_numbers_beyond_64_bits_are_refused(spark):
    frame = spark.createDataFrame([(1, [1e9] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError):
        b.clustered(frame)
