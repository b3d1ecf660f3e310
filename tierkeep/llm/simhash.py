"""SimHash near-duplicates by multi-index hashing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tierkeep.llm.batches import texts_as_bytes
from tierkeep.llm.components import components
from tierkeep.llm.packing import packed, unpacked
from tierkeep.session import cut

#: Words of a shingle, and the most bits by which linked fingerprints differ.
SHINGLE, RADIUS = 3, 2

#: Fingerprints that one table bucket may hold before its links are found in the other way.
BUCKET = 64

SEED = 42

# Bytes that part words become spaces; A-Z become a-z; all else, so every byte of a longer character, stays.
_FOLD = bytes(32 if i in (32, 9, 10, 11, 12, 13) else i + 32 if 65 <= i <= 90 else i for i in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def fingerprint(text: bytes) -> int:
    """64-bit SimHash of a text's word shingles, as a signed number; 0 without words.

    A bit is set if it is set in more than half of the shingles' hashes, repeats included. A text
    of fewer words than a shingle has one shingle.
    """
    words = words_of(text)
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64)
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 65536):  # bounded memory for very long texts
        bits = np.unpackbits(hashes[start : start + 65536].view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(0, dtype=np.uint32)
    packed = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(packed.view(np.int64)[0])


@F.arrow_udf(LongType())
def _fingerprints(texts: pa.Array) -> pa.Array:
    return pa.array((fingerprint(t) for t in texts_as_bytes(texts)), pa.int64())


def with_fingerprints(docs: DataFrame, name: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of ``text`` as bigint; NULL and empty texts have 0."""
    # "not deterministic" keeps Spark from taking them twice, once for a filter that a join implies
    return docs.withColumn(name, _fingerprints.asNondeterministic()(F.col("text")))


def hex_digits(bits: Column) -> Column:
    """A 64-bit number as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def _segment(bits: Column, number: int) -> Column:
    """The upper (0) or lower (1) 32 bits as int."""
    return (F.shiftright(bits, 32) if number == 0 else F.shiftright(F.shiftleft(bits, 32), 32)).cast("int")


def links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """All links (``a``, ``b``: fingerprints) needed to connect fingerprints at most ``RADIUS`` = 2 bits apart.

    ``prints`` has distinct ``fingerprint``. Two of them at most 2 bits apart differ by at most 1
    bit in the upper half, or agree in the lower one. So a table holds each fingerprint under either
    half; each looks up the 33 numbers at most 1 bit from its upper half and its own lower half, and
    what it finds is kept if the whole distance is at most 2.

    A table bucket of more than ``bucket`` fingerprints would be paired with all that look it up.
    Fingerprints that meet such a bucket are linked another way, without pairs: each is put under
    the 65 numbers at most 1 bit away from it, and fingerprints that share a number, which are those
    at most 2 bits apart, are linked with the least of them. At most 65 share one, so this costs 65
    rows each, however many lie close together. Both ways are exact.
    """
    own = F.array(*(F.struct(F.lit(n).alias("half"), _segment(F.col("fingerprint"), n).alias("key")) for n in (0, 1)))
    table = prints.select("fingerprint", F.explode(own).alias("_e")).select("fingerprint", "_e.half", "_e.key")
    flips = [0, *(1 << i for i in range(31)), -(1 << 31)]
    ball = F.transform(
        F.array(*(F.lit(x).cast("int") for x in flips)),
        lambda x: F.struct(F.lit(0).alias("half"), _segment(F.col("fingerprint"), 0).bitwiseXOR(x).alias("key")),
    )
    lower = F.array(F.struct(F.lit(1).alias("half"), _segment(F.col("fingerprint"), 1).alias("key")))
    probes = prints.select("fingerprint", F.explode(F.concat(ball, lower)).alias("_e")).select("fingerprint", "_e.half", "_e.key")

    crowded = cut(table.groupBy("half", "key").count().where(F.col("count") > bucket).select("half", "key"))
    small = table.join(crowded, ["half", "key"], "left_anti").groupBy("half", "key")
    small = small.agg(F.collect_list("fingerprint").alias("_found"))
    # Spark sizes ``probes`` as before the explode, a thirty-fourth of what it is, and would broadcast it
    pairs = probes.join(small.hint("merge"), ["half", "key"]).select("fingerprint", F.explode("_found").alias("_other"))
    near = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("_other"))) <= RADIUS
    pairs = pairs.where((F.col("fingerprint") != F.col("_other")) & near)

    meeting = probes.join(crowded, ["half", "key"], "left_semi").select("fingerprint").distinct()
    masks = F.array(F.lit(0).cast("bigint"), *(F.lit(1 << i).cast("bigint") for i in range(63)), F.lit(-(1 << 63)).cast("bigint"))
    points = meeting.select("fingerprint", F.explode(masks).alias("_m"))
    points = points.withColumn("_point", F.col("fingerprint").bitwiseXOR(F.col("_m")))
    shared = points.groupBy("_point").agg(F.collect_list("fingerprint").alias("_all")).where(F.size("_all") > 1)
    spokes = shared.select(F.array_min("_all").alias("a"), F.explode("_all").alias("b")).where("a <> b")
    return pairs.select(F.col("fingerprint").alias("a"), F.col("_other").alias("b")).union(spokes)


def classes(known: DataFrame) -> DataFrame:
    """``_print``, ``component_id`` (the smallest id reachable) and ``kept_print`` for each fingerprint.

    ``known`` has ``fingerprint`` and ``doc_id``. NULL ids are never smallest: a component of them
    alone has NULL. ``kept_print`` is the fingerprint of the smallest id, the lowest if ids repeat.
    """
    least = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col("fingerprint").alias("print"))
    prints = cut(known.groupBy("fingerprint").agg(F.min(least).alias("_least")))
    hanging = components(links(prints.select("fingerprint")))
    named = prints.join(hanging, F.col("fingerprint") == F.col("node"), "left")
    named = named.select("fingerprint", "_least", F.coalesce("component", "fingerprint").alias("_class"))
    smallest = named.groupBy("_class").agg(F.min("_least").alias("_first"))
    return named.join(smallest, "_class").select(
        F.col("fingerprint").alias("_print"),
        F.col("_first.doc_id").alias("component_id"),
        F.col("_first.print").alias("kept_print"),
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (bigint) and ``component_id``.

    Documents are linked if their fingerprints differ by at most 2 bits; ``component_id`` is the
    smallest id reachable. Texts without words all have fingerprint 0 and are linked. Copies share a
    fingerprint, which stands in the links once, however many they are. ``docs`` needs ``doc_id``
    and ``text``, which is read once. Repeated ids stay as rows. No documents give no rows.
    """
    known = cut(with_fingerprints(docs.select("doc_id", "text")).select("doc_id", "fingerprint"))
    joined = known.join(classes(known), F.col("fingerprint") == F.col("_print"))
    return joined.select("doc_id", "fingerprint", "component_id")


def without_copies(docs: DataFrame) -> DataFrame:
    """One document of each component, in the columns of ``docs``, whatever their names: that with the smallest id.

    If that id repeats, or all ids are NULL, one of its rows stays. Fingerprints are written with
    the ids and taken again at the end, so that texts are moved once and not written; rows of one id
    and fingerprint are reduced to one before they move.
    """
    read = ["doc_id", "text"]
    known = cut(with_fingerprints(docs.select(*read)).select("doc_id", "fingerprint"))
    kept = classes(known).select(F.col("component_id").alias("_id"), F.col("kept_print").alias("_kept")).distinct()
    single = with_fingerprints(packed(docs, read)).dropDuplicates(["doc_id", "fingerprint"])
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("fingerprint") == F.col("_kept"))
    return single.join(cut(kept), same, "left_semi").select(*unpacked(single, docs.columns, read))
