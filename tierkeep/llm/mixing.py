"""Mixing sources to target weights by systematic sampling. DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierkeep.llm.ordering import ranked
from tierkeep.llm.packing import packed, unpacked
from tierkeep.session import cut

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text as long; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0
) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``target``.

    ``sizes`` has ``source`` and ``size``. Sources in code-point order, NULL last, take the
    ``weights`` in turn and share ``share`` times the sum of all sizes. A target stops at ``cap``
    times its source's size and the excess goes to the others by weight: sources fill up in the
    order of cap over weight, and the first of them that does not fill sets the level of the rest.
    The unpartitioned windows run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    filling = Window.orderBy("_full_at", F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onwards = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    total = total.select(
        "source",
        "source_size",
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn).alias("_weight"),
        (F.col("source_size") * F.lit(float(cap))).alias("_cap"),
    )
    total = total.withColumn("_full_at", F.col("_cap") / F.col("_weight"))
    total = total.withColumn(
        "_level",
        (F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
        / F.sum("_weight").over(onwards),
    )
    level = F.max("_level").over(everything)  # it rises while sources fill, and falls after the first that does not
    return total.select("source", "source_size", F.least(F.col("_cap"), F.col("_weight") * level).alias("target"))


def with_copies(
    docs: DataFrame,
    size: Column | None = None,
    seed: str = "mix",
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
) -> DataFrame:
    """``docs`` with ``_size``, ``_source_size``, ``_target`` and ``_copies``, the times a row is taken.

    Within a source every document is expected target / source size times. The prefix sum of these
    expectations, in the order of size and id, is moved by one offset drawn from the source's name
    and ``seed``; a document is taken once per whole number it crosses. In size order the words
    taken miss the target by less than the longest document. Reruns agree.

    ``docs`` needs ``doc_id``, ``source``, and ``text`` unless ``size`` gives the words of a document
    from other columns; all columns pass unchanged. NULL or empty
    texts have size 0. A source of size 0 has target 0; its documents are taken once. NULL sources
    are one source. Repeated rows are taken one by one. No documents give no rows. Columns whose
    names start with an underscore are reserved.
    """
    sized = docs.withColumn("_size", word_count(F.col("text")) if size is None else size)
    targets = cut(
        source_targets(sized.select("source", F.col("_size").alias("size")), weights, share, cap)
    ).select(F.col("source").alias("_name"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"))
    placed = ranked(sized, ["source"], ["_size", "doc_id"], "_rank")
    placed = placed.join(targets, F.col("source").eqNullSafe(F.col("_name")), "left")
    each = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(F.lit(1.0))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("source"), F.lit("")))
    offset = F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
    crossed = F.floor(F.col("_rank") * each + offset) - F.floor((F.col("_rank") - 1) * each + offset)
    return placed.withColumn("_copies", crossed.cast("int")).drop("_rank", "_name")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as many times as it is taken, in the columns of ``docs``, whatever their names."""
    read = ["doc_id", "text", "source"]
    taken = with_copies(packed(docs, read), **options)
    repeated = taken.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("_copies"))))
    return repeated.select(*unpacked(repeated, docs.columns, read))
