"""Sharding by a k-d tree over metadata, split at weighted medians. DataFrame operations only."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierkeep.llm.ordering import ranked
from tierkeep.llm.packing import packed, unpacked
from tierkeep.session import cut

#: Every dimension is laid out over so many bins; ties in a bin are split by a hash of so many bits.
BINS, TIE_BITS = 4096, 16

_DIMENSION = "_d"


def byte_size(text: Column) -> Column:
    """UTF-8 bytes of a text (NULL: none) plus 1."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1


def document_dimensions() -> dict[str, Column]:
    """Metadata of a document as numbers: its id, the logarithm of its size, source and language by hash."""
    return {
        "doc_id": F.col("doc_id").cast("double"),
        "size": F.log2(byte_size(F.col("text")).cast("double")),
        "source": F.crc32(F.col("source").cast("binary")).cast("double"),
        "lang": F.crc32(F.col("lang").cast("binary")).cast("double"),
    }


def document_tie() -> Column:
    """Spreads documents that lie in one bin; rows equal in id and text can't be told apart."""
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def _laid_out(df: DataFrame, dimensions: Mapping[str, Column], weight: Column, tie: Column) -> DataFrame:
    """``df`` with a bin number per dimension (NULL: the first), ``_w``, ``_tie`` and the root as ``_node``.

    Only the least and the largest value of each dimension come to the driver.
    """
    named = {f"{_DIMENSION}{i}": c for i, c in enumerate(dimensions.values())}
    span = df.agg(
        *(f(c).alias(f"{n}_{k}") for n, c in named.items() for k, f in (("lo", F.min), ("hi", F.max)))
    ).first()
    bins = {}
    for n, c in named.items():
        lo, hi = span[f"{n}_lo"], span[f"{n}_hi"]
        step = (hi - lo) / (BINS - 1) if lo is not None and hi > lo else 0.0
        place = F.floor((c - F.lit(lo)) / F.lit(step)) if step else F.lit(0)
        bins[n] = F.coalesce(place, F.lit(0)).cast("int")
    return df.withColumns(
        {
            **bins,
            "_w": weight.cast("bigint"),
            "_tie": F.shiftrightunsigned(tie, 64 - TIE_BITS).cast("int"),
            "_node": F.lit(1).cast("bigint"),
        }
    )


def _crossing(weights: DataFrame, by: str, half: Column) -> DataFrame:
    """Per node, the first value of ``by`` at which the running weight comes nearest to ``half`` from below.

    Rows: ``_node``, ``by``, ``_below`` (weight before it).
    """
    running = Window.partitionBy("_node").orderBy(by)
    sums = weights.withColumn("_upto", F.sum("_w").over(running)).withColumn("_below", F.col("_upto") - F.col("_w"))
    first = sums.where(F.col("_upto") >= half).groupBy("_node")
    return first.agg(F.min_by(by, by).alias(by), F.min("_below").alias("_below"))


def _splits(rows: DataFrame, n_dimensions: int, target: float) -> DataFrame:
    """One row per node heavier than ``target``: its widest dimension, the median's bin, and the tie to split at.

    All three passes are sums taken in the map tasks. A window runs over the bins of one node.
    """
    names = [f"{_DIMENSION}{i}" for i in range(n_dimensions)]
    wide = rows.groupBy("_node").agg(
        F.sum("_w").alias("_total"), *((F.max(n) - F.min(n)).alias(n) for n in names)
    )
    widest = F.array_position(F.array(*names), F.greatest(*names) if len(names) > 1 else F.col(names[0]))
    wide = wide.where(F.col("_total") > F.lit(float(target))).select("_node", "_total", (widest - 1).cast("int").alias("_dim"))
    nodes = cut(wide)
    inside = rows.join(nodes, "_node")
    chosen = F.element_at(F.array(*names), F.col("_dim") + 1)
    by_bin = inside.groupBy("_node", "_dim", "_total", chosen.alias("_bin")).agg(F.sum("_w").alias("_w"))
    half = F.col("_total") / 2
    bins = cut(_crossing(by_bin, "_bin", half).join(nodes, "_node"))
    at = rows.join(bins, "_node").where(chosen == F.col("_bin"))
    by_tie = at.groupBy("_node", "_total", "_below", F.col("_tie").alias("_cut")).agg(F.sum("_w").alias("_w"))
    running = Window.partitionBy("_node").orderBy("_cut")
    by_tie = by_tie.withColumn("_upto", F.col("_below") + F.sum("_w").over(running))
    # ties up to _cut go left: the cut whose left side is nearest to half; -1 sends the whole bin right
    near = F.struct(F.abs(F.col("_upto") - half).alias("gap"), F.col("_cut").alias("cut"))
    best = by_tie.groupBy("_node").agg(F.min(near).alias("_near"))
    whole = F.abs(F.col("_below") - half) <= F.col("_near.gap")
    cuts = bins.join(best, "_node")
    return cut(
        cuts.select("_node", "_dim", "_bin", F.when(whole, F.lit(-1)).otherwise(F.col("_near.cut")).alias("_cut"))
    )


def kd_nodes(
    df: DataFrame,
    dimensions: Mapping[str, Column],
    weight: Column,
    tie: Column,
    depth: int | None = None,
    target: float | None = None,
) -> DataFrame:
    """``df`` with ``_node``, the number of its leaf: the root is 1, the children of k are 2k and 2k + 1.

    Nodes are split at the weighted median of the dimension along which they are widest, in bins,
    until ``depth`` levels are done or every leaf weighs at most ``target``. Values that share the
    median's bin, however many rows they hold, are split by ``tie``; rows equal in all of these stay
    together, so a leaf of nothing else may stay heavier. The number of splits is that of the
    leaves; a level's splits are a written table which Spark broadcasts if it is small.
    """
    if (depth is None) == (target is None):
        raise ValueError("give depth or target")
    narrow = _laid_out(df, dimensions, weight, tie)
    names = [f"{_DIMENSION}{i}" for i in range(len(dimensions))]
    rows = cut(narrow.select("_node", *names, "_w", "_tie"))
    full = narrow
    total = rows.agg(F.sum("_w")).first()[0] or 0
    levels = depth if depth is not None else max(0, math.ceil(math.log2(max(1.0, total / target)))) + 2
    for _ in range(levels):
        splits = _splits(rows, len(names), -1 if depth is not None else target)
        rows, full = (_descended(x, splits, names) for x in (rows, full))
    return full.drop(*names, "_w", "_tie")


def _descended(rows: DataFrame, splits: DataFrame, names: list[str]) -> DataFrame:
    """Every row of a split node moves to its left or right child."""
    value = F.element_at(F.array(*names), F.col("_dim") + 1)
    right = (value > F.col("_bin")) | ((value == F.col("_bin")) & (F.col("_tie") > F.col("_cut")))
    child = F.when(F.col("_dim").isNull(), F.col("_node")).otherwise(F.col("_node") * 2 + right.cast("int"))
    kept = [c for c in rows.columns if c != "_node"]
    return rows.join(splits, "_node", "left").select(*kept, child.alias("_node"))


def sharded(
    docs: DataFrame,
    depth: int = 3,
    dimensions: Mapping[str, Column] | None = None,
    size: Column | None = None,
    tie: Column | None = None,
) -> DataFrame:
    """``docs`` with ``shard`` (0 to 2^depth - 1), ``slot`` (gapless from 0 in each shard) and ``size``.

    Shards hold nearly equal bytes. ``docs`` needs ``doc_id``, ``text``, ``source``, ``lang``, or
    whatever ``dimensions``, ``size`` and ``tie`` read if these are given (and ``doc_id``); other
    columns pass whatever their names, except that those named like the three new ones are replaced. NULL texts weigh
    1, NULL metadata counts as the least value. Fewer documents than shards leave shards empty; no
    documents give no rows. Rows equal in id and text share a shard.
    """
    kept = [c for c in docs.columns if c not in ("shard", "slot", "size")]
    read = ["doc_id", "text", "source", "lang"] if dimensions is None else kept
    weight = byte_size(F.col("text")) if size is None else size
    leaves = kd_nodes(
        packed(docs.select(*(f"`{c}`" for c in kept)), read),
        document_dimensions() if dimensions is None else dimensions,
        weight,
        document_tie() if tie is None else tie,
        depth=depth,
    )
    placed = leaves.select(
        *(c for c in leaves.columns if c != "_node"),
        weight.alias("size"),
        (F.col("_node") - F.lit(2**depth)).cast("int").alias("shard"),
    )
    numbered = ranked(placed, ["shard"], ["doc_id", "size"], "_rank")
    return numbered.select(*unpacked(numbered, kept, read), "size", "shard", (F.col("_rank") - 1).alias("slot"))
