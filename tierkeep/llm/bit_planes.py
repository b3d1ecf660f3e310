"""Centroid clustering of integer vectors with exact dot products from bit planes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierkeep.session import cut

#: Components of a vector: as many as a machine word has bits, so that a bit plane is one number.
WIDTH = 64

#: A component x becomes floor(SCALE * x), of a size below LIMIT, so that squared distances are 64-bit numbers.
SCALE, LIMIT = 1024, 1 << 27

#: Rows worked off at a time.
ROWS = 4096


def plane_weights(planes: int) -> np.ndarray:
    """What a bit of each plane is worth: powers of two, the last negative (two's complement)."""
    weights = [1 << i for i in range(planes)]
    weights[-1] = -weights[-1]
    return np.array(weights, np.int64)


def planes_needed(low: int, high: int) -> int:
    """Bit planes that hold all numbers from ``low`` to ``high``."""
    return max(int(high).bit_length(), (-int(low) - 1).bit_length() if low < 0 else 0) + 1


def packed_planes(vectors: np.ndarray, planes: int) -> np.ndarray:
    """Bit planes of int64 vectors (n x 64) as n x planes uint64: bit k of plane i is bit i of component k."""
    out = np.empty((len(vectors), planes), np.uint64)
    for i in range(planes):
        bits = ((vectors >> i) & 1).astype(np.uint8)
        out[:, i] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def dot_products(a: np.ndarray, b: np.ndarray, planes: int) -> np.ndarray:
    """Exact dot products of packed vectors ``a`` (n x planes) with ``b`` (k x planes), as n x k int64.

    A pair of planes contributes its weights' product times the number of components with both bits.
    """
    weights = plane_weights(planes)
    out = np.zeros((len(a), len(b)), np.int64)
    for j, other in enumerate(b):
        for i in range(planes):
            if other[i]:
                out[:, j] += (np.bitwise_count(a & other[i]).astype(np.int64) @ weights) * weights[i]
    return out


def nearest(a: np.ndarray, norms: np.ndarray, centroids: np.ndarray, planes: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest of ``centroids`` (k x 64 int64), the smaller if equally near, and the squared distance."""
    squares = (centroids * centroids).sum(1)
    distances = norms[:, None] + squares[None, :] - 2 * dot_products(a, packed_planes(centroids, planes), planes)
    best = distances.argmin(1)
    return best, distances[np.arange(len(a)), best]


def _lists(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)


_PACKED = "row bigint, vec_id bigint, planes binary, norm bigint, vector array<int>"


def _packed(kept: DataFrame, planes: int) -> DataFrame:
    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                rows = batch.slice(start, ROWS)
                vectors = _lists(rows.column("vector")).astype(np.int64)
                data = packed_planes(vectors, planes).astype("<u8").tobytes()
                step = planes * 8
                columns = [
                    rows.column("row"),
                    rows.column("vec_id"),
                    pa.array([data[i : i + step] for i in range(0, len(data), step)], pa.binary()),
                    pa.array((vectors * vectors).sum(1)),
                    rows.column("vector"),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["row", "vec_id", "planes", "norm", "vector"])

    return kept.mapInArrow(pack, _PACKED)


def _read(batch: pa.RecordBatch, planes: int) -> tuple[np.ndarray, np.ndarray]:
    data = b"".join(batch.column("planes").to_pylist())
    return np.frombuffer(data, "<u8").reshape(-1, planes), batch.column("norm").to_numpy()


def _sums(packed: DataFrame, centroids: np.ndarray, planes: int) -> dict[int, tuple[int, list[int]]]:
    """Number of vectors and componentwise sums of each cluster that has vectors; a row per cluster reaches the driver."""
    k = len(centroids)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, WIDTH), np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                rows = batch.slice(start, ROWS)
                best, _ = nearest(*_read(rows, planes), centroids, planes)
                vectors = _lists(rows.column("vector"))
                for c in np.unique(best):
                    mine = vectors[best == c]
                    counts[c] += len(mine)
                    sums[c] += mine.sum(0, dtype=np.int64)
        full = np.flatnonzero(counts)
        columns = [pa.array(full.astype(np.int32)), pa.array(counts[full]), pa.array(sums[full].tolist(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "sums"])

    found = packed.select("planes", "norm", "vector").mapInArrow(add, "cluster int, n bigint, sums array<bigint>")
    whole = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(WIDTH)]
    rows = found.groupBy("cluster").agg(F.sum("n").alias("n"), *whole).collect()
    return {r["cluster"]: (r["n"], [int(r[f"s{i}"]) for i in range(WIDTH)]) for r in rows}


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``vector`` (array of bigint) of the vectors with exactly 64 components, none NULL, NaN or infinite."""
    x = F.col("embedding").cast("array<double>")
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = vectors.where((F.size("embedding") == WIDTH) & good)
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.transform(x, lambda v: F.floor(v * scale)).alias("vector"))


def clustered(vectors: DataFrame, clusters: int = 8, rounds: int = 10, seed: str = "3") -> DataFrame:
    """k-means on integers: ``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``.

    ``vectors`` has ``vec_id`` and ``embedding``. Vectors without exactly 64 finite components are
    left out; a component x counts as floor(1024 * x). The first centroids are the vectors with the
    smallest sha256 of ``<seed>:<vec_id>`` (then the smallest components), or all if there are fewer.
    Each round assigns every vector to the nearest centroid and replaces each centroid that has
    vectors by the floor of their mean; then vectors are assigned once more. Everything is exact:
    distances come from bit planes, sums from whole numbers.

    Vectors are packed and written once; a round reads them and moves one row per task and cluster.
    A repeated id is as many vectors; a NULL id has the hash of ``<seed>:``. No vectors give no
    rows. Other columns are not read. Components of 2**27 or more after scaling raise ValueError, as
    their distances would not fit 64 bits.
    """
    kept = integer_vectors(vectors)
    edge = kept.agg(F.min(F.array_min("vector")).alias("low"), F.max(F.array_max("vector")).alias("high")).first()
    low, high = (edge["low"] or 0, edge["high"] or 0)
    if max(-low, high) >= LIMIT:
        raise ValueError(f"components from {low} to {high} are too large")
    planes = planes_needed(low, high)
    numbered = kept.select(F.monotonically_increasing_id().alias("row"), "vec_id", F.col("vector").cast("array<int>").alias("vector"))
    packed = cut(_packed(numbered, planes))
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = packed.orderBy(hashed, "vector").select("vector").limit(clusters).collect()
    centroids = np.array([r["vector"] for r in first], np.int64).reshape(-1, WIDTH)
    for _ in range(rounds):
        found = _sums(packed, centroids, planes)
        moved = [[s // found[c][0] for s in found[c][1]] if c in found else old.tolist() for c, old in enumerate(centroids)]
        if moved == centroids.tolist():  # settled: further rounds change nothing
            break
        centroids = np.array(moved, np.int64)

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                rows = batch.slice(start, ROWS)
                best, distance = nearest(*_read(rows, planes), centroids, planes)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("vec_id"), pa.array(best.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"]
                )

    near = cut(packed.select("vec_id", "planes", "norm").mapInArrow(assign, "vec_id bigint, cluster int, distance bigint"))
    # one row per cluster
    sums = {r["cluster"]: int(r["d"]) for r in near.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    names = [",".join(map(str, c)) for c in centroids.tolist()]
    about = near.sparkSession.createDataFrame(
        [(c, sums.get(c, 0), sum(sums.values()), name) for c, name in enumerate(names)],
        "_cluster int, cluster_inertia bigint, inertia bigint, components string",
    )
    joined = near.join(F.broadcast(about), F.col("cluster") == F.col("_cluster"))
    return joined.select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2("components", 256).alias("centroid_sha256")
    )
