"""Near copies by exact Jaccard similarity of word shingles: fingerprints and min-wise keys propose, sets decide."""

from __future__ import annotations

from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tierkeep.llm import simhash
from tierkeep.llm.batches import map_batches, texts_as_bytes
from tierkeep.llm.components import components
from tierkeep.llm.packing import packed, unpacked
from tierkeep.llm.simhash import SEED, words_of
from tierkeep.session import cut, scratch

#: Words of a shingle. Texts are near copies if 5 * (shingles in both) >= 4 * (shingles in either).
SHINGLE = 5

#: Keys of a text, and min-wise values in each.
KEYS, VALUES = 24, 5

#: Texts that one key may hold before they are compared by their rarest shingles instead of all with all.
CROWD = 32

#: Bits of a sketch, a power of two. Few bits only let more pairs pass to the sets, so long texts need no more.
BITS = 1024

_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(numbers: np.ndarray) -> np.ndarray:
    numbers = (numbers ^ (numbers >> np.uint64(31))) * _MIX
    return numbers ^ (numbers >> np.uint64(29))


_SALTS = _mixed(_mixed(np.arange(1, KEYS * VALUES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
_FACTORS = _mixed(_SALTS + np.uint64(1)) | np.uint64(1)


def shingles(text: bytes) -> np.ndarray:
    """The 64-bit hashes of a text's distinct shingles, sorted; a text of fewer words than a shingle has one, or none."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(SHINGLE, len(words))
    found = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        found = _mixed(found + hashes[i : i + len(found)])
    return np.unique(found)


def _print(hashes: np.ndarray) -> int:
    """One number for a set of shingles."""
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), SEED)).view(np.int64))


def fingerprint(hashes: np.ndarray) -> int:
    """64-bit SimHash of a set of shingles, as a signed number; 0 without any."""
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 65536):  # bounded memory for very long texts
        part = hashes[start : start + 65536].view(np.uint8)
        ones += np.unpackbits(part, bitorder="little").reshape(-1, 64).sum(0, dtype=np.uint32)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def keys(hashes: np.ndarray) -> np.ndarray:
    """``KEYS`` numbers of a set of shingles, none for an empty one; the more alike two sets, the more of them are equal.

    Each stands for the least shingles under ``VALUES`` random orders, of which one is the same in
    two sets with the chance of their Jaccard similarity. So a pair at 0.8 shares none of the keys
    with a chance of (1 - 0.8^5)^24 = 7e-5, and one at 0.3 shares any with a chance of 0.06.
    """
    if not len(hashes):
        return np.empty(0, np.uint64)
    least = np.full(KEYS * VALUES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), 1024):
        least = np.minimum(least, ((hashes[start : start + 1024, None] ^ _SALTS) * _FACTORS).min(0))
    least, found = least.reshape(KEYS, VALUES), np.arange(KEYS, dtype=np.uint64)
    for i in range(VALUES):
        found = _mixed(found + least[:, i])
    return found


def sketch(hashes: np.ndarray) -> np.ndarray:
    """``BITS`` bits as signed 64-bit numbers, each odd or even like the number of the set's shingles that fall on it.

    Shingles in both of two sets leave each bit equal or turn it in both, so two sketches differ in
    no more bits than there are shingles in one of the sets only. Of near copies, these are at most
    a ninth of the shingles of both, counted in each.
    """
    places = (hashes >> np.uint64(65 - BITS.bit_length())).astype(np.int64)
    return np.packbits(np.bincount(places, minlength=BITS) & 1).view(np.int64)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    values = np.concatenate(rows).view(np.int64) if rows else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def _known(docs: DataFrame) -> DataFrame:
    """``doc_id``, and ``print``, number of shingles, fingerprint and keys of the text; a few hundred texts at a time in memory."""

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        sets = [shingles(t) for t in texts_as_bytes(batch.column("text"))]
        return {
            "doc_id": batch.column("doc_id"),
            "print": pa.array(map(_print, sets), pa.int64()),
            "n": pa.array(map(len, sets), pa.int64()),
            "fingerprint": pa.array(map(fingerprint, sets), pa.int64()),
            "keys": _lists([keys(s) for s in sets]),
        }

    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_batches(ids, work, "doc_id bigint, print bigint, n bigint, fingerprint bigint, keys array<bigint>")


def _sets_of(texts: DataFrame) -> DataFrame:
    """``node`` (print) and ``set`` of every ``text``."""

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        sets = [shingles(t) for t in texts_as_bytes(batch.column("text"))]
        return {"node": pa.array(map(_print, sets), pa.int64()), "set": _lists(sets)}

    return map_batches(texts.select("text"), work, "node bigint, set array<bigint>")


def _sketches(sets: DataFrame) -> DataFrame:
    """``node`` and ``sketch`` of every ``set``."""

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        found = batch.column("set")
        ends, values = found.offsets.to_numpy(), found.values.to_numpy().view(np.uint64)
        return {"node": batch.column("node"), "sketch": _lists([sketch(values[a:b]) for a, b in zip(ends, ends[1:])])}

    return map_batches(sets.select("node", "set"), work, "node bigint, sketch array<bigint>")


@F.arrow_udf(LongType())
def _prints(texts: pa.Array) -> pa.Array:
    return pa.array((_print(shingles(t)) for t in texts_as_bytes(texts)), pa.int64())


def _named_sets(named: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """``node`` and ``set`` of the texts whose prints ``named`` holds as ``_node``, each read from one of its documents."""
    same = F.col("doc_id").eqNullSafe(F.col("_id"))
    ids = cut(nodes.join(named.distinct(), F.col("print") == F.col("_node"), "left_semi").select(F.col("doc_id").alias("_id")).distinct())
    # an id may repeat with other texts; those not named are not asked for later
    return cut(_sets_of(docs.select("doc_id", "text").join(ids, same, "left_semi")).dropDuplicates(["node"]))


def _of_size(m: str, n: str) -> Column:
    return (5 * F.least(m, n)) >= (4 * F.greatest(m, n))


def _ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Those of the distinct ``pairs`` (``a``, ``b``: prints) that are near copies; only texts named in them are read."""
    with scratch(pairs.sparkSession) as keep:
        pairs = cut(pairs)
        sets = _named_sets(pairs.select(F.explode(F.array("a", "b")).alias("_node")), nodes, docs)
        both = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("_sa")), "a")
        both = both.join(sets.select(F.col("node").alias("b"), F.col("set").alias("_sb")), "b")
        common = F.size(F.array_intersect("_sa", "_sb"))
        return keep(cut(both.where(5 * common >= 4 * (F.size("_sa") + F.size("_sb") - common)).select("a", "b")))


def _parts(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``print``, ``n``, and ``part``, the least print that it reaches by ``links``."""
    parts = components(links).select(F.col("node").alias("_node"), F.col("component").alias("_part"))
    return nodes.join(parts, F.col("print") == F.col("_node"), "left").select("print", "n", F.coalesce("_part", "print").alias("part"))


def _by_fingerprint(nodes: DataFrame) -> DataFrame:
    """Pairs (``a``, ``b``: prints) of texts whose fingerprints are equal or linked within two bits, one text per fingerprint."""
    least = cut(nodes.groupBy("fingerprint").agg(F.min("print").alias("_least")))
    equal = nodes.join(least, "fingerprint").where("print <> _least").select(*_ordered("print", "_least"))
    linked = simhash.links(least.select("fingerprint"))
    for end in ("a", "b"):
        of = least.select(F.col("fingerprint").alias(end), F.col("_least").alias(f"_{end}"))
        linked = linked.join(of, end)
    return equal.union(linked.select(*_ordered("_a", "_b"))).where("a <> b").distinct()


def _by_rarest(crowd: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs (``a``, ``b``) of the texts of ``crowd`` (``print``, ``n``, ``part``), among them all near copies in different parts.

    Shingles are put in one order, from those in the fewest texts of the crowd on. Of near copies,
    the larger one has among its rarest fifth, and the smaller one among its rarest ninth, the first
    shingle that both have; so shingles that a template gives to all its pages, which come last,
    bring no pairs. A pair is formed only where the shingle, were it the first that both have, leaves
    enough behind it in both texts to reach the similarity, and only if the sketches do not rule the
    similarity out; so texts of one origin, too far apart to be near copies, bring hardly any.
    """
    sets = _named_sets(crowd.select(F.col("print").alias("_node")), nodes, docs)
    rows = crowd.join(sets, F.col("print") == F.col("node")).select("print", "n", "part", F.explode("set").alias("s"))
    counts = cut(rows.groupBy("s").count().where("count > 1"))
    rows = rows.join(counts, "s", "left").withColumn("_c", F.coalesce("count", F.lit(1)))
    rows = rows.withColumn("_at", F.row_number().over(Window.partitionBy("print").orderBy("_c", "s")))
    # n - ceil(0.8 n) + 1 of them
    front = rows.where("_c > 1 and 5 * (_at - 1) <= n").join(_sketches(sets), F.col("print") == F.col("node"))
    front = cut(front.select("s", "print", "n", "part", "_at", "sketch"))
    small = front.where("9 * (_at - 1) <= n")
    large = front.select("s", *(F.col(c).alias(f"_{c}") for c in ("print", "n", "part", "sketch")), F.col("_at").alias("_place"))
    # rows of one text repeat its sketch, so their file is many times smaller than they are in a broadcast
    met = small.join(large.hint("merge"), "s").where(F.struct("n", "print") < F.struct("_n", "_print"))
    both = F.col("n") + F.col("_n")
    most = 1 + F.least(F.col("n") - F.col("_at"), F.col("_n") - F.col("_place"))
    met = met.where((F.col("part") != F.col("_part")) & _of_size("n", "_n") & (9 * most >= 4 * both))
    words = (F.bit_count(F.col("sketch")[i].bitwiseXOR(F.col("_sketch")[i])) for i in range(BITS // 64))
    met = met.where(9 * reduce(add, words) <= both)
    return met.select(*_ordered("print", "_print")).distinct()


def links(nodes: DataFrame, docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Links (``a``, ``b``: prints) that connect near copies; ``nodes`` has one row per print with its ``doc_id``,
    ``n``, ``fingerprint`` and ``keys``.

    First the texts that multi-index hashing finds within two bits of one another; then, of the
    texts that share a key and are not connected yet, each with two that share it; then those still
    apart: all pairs of a key, or, where it holds more than ``crowd`` texts, pairs by their rarest
    shingles. Every pair is verified on the whole sets.
    """
    with scratch(docs.sparkSession) as keep:
        within = _verified(_by_fingerprint(nodes), nodes, docs)
        parted = cut(_parts(nodes, within))
        keyed = parted.join(nodes.select(F.col("print").alias("_node"), "keys"), F.col("print") == F.col("_node"))
        rows = keyed.select("print", "n", "part", F.explode("keys").alias("key"))
        shared = rows.groupBy("key").agg(F.min("part").alias("_lo"), F.max("part").alias("_hi"))
        shared = cut(shared.where("_lo < _hi").select("key"))
        asked = cut(rows.join(shared, "key", "left_semi"))

        node = F.struct(F.col("part").alias("t"), F.col("print").alias("p"), F.col("n").alias("m"))
        hubs = cut(asked.groupBy("key").agg(F.array(F.min(node), F.max(node)).alias("_hubs")))
        stars = asked.join(hubs, "key").select("print", "n", "part", F.explode("_hubs").alias("_hub"))
        stars = stars.where((F.col("part") != F.col("_hub.t")) & _of_size("n", "_hub.m"))
        pairs = cut(stars.select("print", F.col("_hub.p").alias("_p")).select(*_ordered("print", "_p")).distinct())
        first = cut(within.union(_verified(pairs, nodes, docs)))

        parted = cut(_parts(nodes, first))
        named = asked.select("key", F.col("print").alias("_node")).join(parted, F.col("print") == F.col("_node"))
        named = cut(named.select("key", "print", "n", "part"))
        split = named.groupBy("key").agg(F.min("part").alias("_lo"), F.max("part").alias("_hi"), F.count("*").alias("_all"))
        # up to three texts of a key have all been compared
        split = cut(split.where("_lo < _hi and _all > 3").select("key", "_all"))
        few, many = split.where(F.col("_all") <= crowd).select("key"), split.where(F.col("_all") > crowd).select("key")
        left = cut(named.join(few, "key", "left_semi"))
        right = left.select("key", *(F.col(c).alias(f"_{c}") for c in ("print", "n", "part")))
        rest = left.join(right, "key").where((F.col("print") < F.col("_print")) & (F.col("part") != F.col("_part")) & _of_size("n", "_n"))
        crowded = cut(named.join(many, "key", "left_semi").select("print", "n", "part").distinct())
        rest = rest.select(*_ordered("print", "_print")).union(_by_rarest(crowded, nodes, docs)).distinct()
        last = _verified(rest.join(pairs, ["a", "b"], "left_anti"), nodes, docs)
        return keep(cut(first.union(last)))


def without_near_copies(docs: DataFrame) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies, in the columns of ``docs``, whatever their names.

    Two texts are near copies if their sets of five-word shingles have a Jaccard similarity of at
    least 0.8; groups are what chains of near copies connect. Texts without words are copies of one
    another. Only near copies are linked; a pair of them at exactly 0.8 is not seen with a chance of
    7e-5, and one at 0.9 with 2e-10. Shingles and sets are compared by 64-bit hashes. If the
    smallest id repeats, or all ids are NULL, one of its rows stays.

    Documents whose id occurs once are left out by it where they lie. Only those of repeated or no
    ids are hashed again and moved.
    """
    with scratch(docs.sparkSession) as keep:
        known = cut(_known(docs))
        least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("_l")
        nodes = known.groupBy("print").agg(least, *(F.first(c).alias(c) for c in ("n", "fingerprint", "keys")))
        nodes = cut(nodes.select("print", F.col("_l.doc_id").alias("doc_id"), "n", "fingerprint", "keys"))
        parted = _parts(nodes, links(nodes, docs))
        named = nodes.select(F.col("print").alias("_node"), "doc_id").join(parted, F.col("print") == F.col("_node"))
        first = named.groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "print")).alias("_f"))
        kept = keep(cut(first.select(F.col("_f.doc_id").alias("_id"), F.col("_f.print").alias("_kept"))))

        prints = known.select("doc_id", "print")
        counted = prints.groupBy("doc_id").count()
        repeated = keep(cut(counted.where("doc_id is null or count > 1").select(F.col("doc_id").alias("_id"))))
        same = F.col("doc_id").eqNullSafe(F.col("_id"))
        dropped = prints.join(kept, same & (F.col("print") == F.col("_kept")), "left_anti").select(F.col("doc_id").alias("_id"))
        gone = keep(cut(dropped.union(repeated).distinct()))
    read = ["doc_id", "text"]
    rest = packed(docs, read)
    single = rest.join(gone, same, "left_anti")
    again = rest.join(repeated, same, "left_semi").withColumn("_print", _prints.asNondeterministic()(F.col("text")))
    again = again.dropDuplicates(["doc_id", "_print"])
    again = again.join(kept, same & (F.col("_print") == F.col("_kept")), "left_semi").drop("_print")
    whole = single.union(again)
    return whole.select(*unpacked(whole, docs.columns, read))
