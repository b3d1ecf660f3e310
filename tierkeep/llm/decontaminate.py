"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from tierkeep.llm.batches import map_batches, texts_as_bytes
from tierkeep.llm.packing import packed, unpacked
from tierkeep.session import cut

#: Words of the shortest tile (of a shorter test: all its words), and the share of a test's words that tiles must cover.
TILE, COVERAGE = 5, 0.6

#: The sieve of seeds has 2^24 places, one bit each (2 MiB), whatever the size of the benchmark; a
#: seed passes if both of its places are taken: the upper 24 bits of its hash, and the 24 below them.
SIEVE_BITS = 24
SIEVE_SHIFTS = (64 - SIEVE_BITS, 64 - 2 * SIEVE_BITS)

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

# A-Z become a-z; digits, a-z and every byte of a longer character stay; all else parts words.
_FOLD = bytes(
    i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i >= 128 else 32 for i in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def word_numbers(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint64, len(words))


def _powers(factor: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, factor, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def rolling(numbers: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes, modulo 2^64, of every window of ``length`` numbers."""
    n = len(numbers)
    if n < length:
        return np.empty(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((numbers + np.uint64(1)) * _powers(_FACTOR, n), out=sums[1:])
    raw = (sums[length:] - sums[:-length]) * _powers(_INVERSE, n - length + 1)
    return (raw ^ (raw >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def tiles(text: list[bytes], test: list[bytes], least: int = TILE) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in the text, place in the test, words), longest tiles first.

    The search length falls from the test's length to ``least``; at each length every pair of equal
    windows, found by Karp-Rabin and compared word by word, that holds no marked word becomes a tile,
    from left to right. As longer matches are marked before, each tile is as long as any left.
    Only the parts of the text that share a seed with the test are searched.
    """
    if len(test) < least or len(text) < least:
        return []
    numbers, goal = word_numbers(text), word_numbers(test)
    seeded = np.isin(rolling(numbers, least), rolling(goal, least))
    inside = np.zeros(len(text) + 1, np.int64)
    starts = np.flatnonzero(seeded)
    np.add.at(inside, starts, 1)
    np.add.at(inside, starts + least, -1)
    at = np.flatnonzero(np.cumsum(inside[:-1]) > 0)  # places in the text that are searched
    if not len(at):
        return []
    numbers = numbers[at]
    free_text, free_test = np.ones(len(at), bool), np.ones(len(test), bool)
    found: list[tuple[int, int, int]] = []

    def open_windows(free: np.ndarray, length: int, places: np.ndarray | None = None) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(free)])
        whole = sums[length:] - sums[:-length] == length
        return whole if places is None else whole & (places[length - 1 :] - places[: len(places) - length + 1] == length - 1)

    for length in range(min(len(at), len(test)), least - 1, -1):
        targets: dict[int, list[int]] = {}
        hashes = rolling(goal, length)
        for j in np.flatnonzero(open_windows(free_test, length)).tolist():
            targets.setdefault(int(hashes[j]), []).append(j)
        if not targets:
            continue
        hashes = rolling(numbers, length)
        hit = open_windows(free_text, length, at) & np.isin(hashes, np.fromiter(targets, np.uint64, len(targets)))
        for i in np.flatnonzero(hit).tolist():
            if not free_text[i : i + length].all():
                continue
            for j in targets[int(hashes[i])]:
                if free_test[j : j + length].all() and text[at[i] : at[i] + length] == test[j : j + length]:
                    free_text[i : i + length] = free_test[j : j + length] = False
                    found.append((int(at[i]), j, length))
                    break
    return found


def tile_words(test: list[bytes]) -> int:
    """Words of the shortest tile, and of a seed, of a test."""
    return min(TILE, len(test))


_SEEDS = ("seed", "n", "words", "least")


@F.arrow_udf(ArrayType(StructType([StructField(name, LongType()) for name in _SEEDS])))
def _seeds(texts: pa.Array) -> pa.Array:
    """Hashes of the distinct seeds of each test, their places in it, and the words of test and seed."""
    rows = []
    for t in texts_as_bytes(texts):
        words = words_of(t)
        least = tile_words(words)
        seeds, n = np.unique(rolling(word_numbers(words), least), return_counts=True) if words else ((), ())
        rows.append([{"seed": int(s), "n": int(k), "words": len(words), "least": least} for s, k in zip(np.asarray(seeds, np.uint64).view(np.int64), n)])
    kinds = [(name, pa.int64()) for name in _SEEDS]
    return pa.array(rows, pa.list_(pa.struct(kinds)))


def _sieve(seeds: DataFrame) -> bytes:
    """One bit per place that a seed takes: at most 2^24 bits come to the driver, in words of 32."""
    places = [F.shiftrightunsigned("seed", n).bitwiseAND(F.lit((1 << SIEVE_BITS) - 1)) for n in SIEVE_SHIFTS]
    placed = seeds.select(F.explode(F.array(*places)).alias("_place"))
    words = placed.groupBy(F.shiftright("_place", 5).alias("w")).agg(
        F.expr("bit_or(shiftleft(1L, cast(_place % 32 as int)))").alias("bits")
    )
    out = np.zeros(1 << (SIEVE_BITS - 5), np.uint32)
    found = words.toPandas()
    out[found["w"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).astype(np.uint32)
    return out.tobytes()


def _passes(seeds: np.ndarray, bits: np.ndarray) -> np.ndarray:
    passed = np.ones(len(seeds), bool)
    for n in SIEVE_SHIFTS:
        place = (seeds >> np.uint64(n)).astype(np.int64) & ((1 << SIEVE_BITS) - 1)
        passed &= (bits[place >> 5] >> (place & 31).astype(np.uint32)) & np.uint32(1) == 1
    return passed


def _sifted(sieve: bytes, lengths: list[int]):
    """A function of texts: the seeds of each, of all lengths that seeds of tests have, that may be seeds of a test."""

    @F.arrow_udf(ArrayType(LongType()))
    def sift(texts: pa.Array) -> pa.Array:
        bits = np.frombuffer(sieve, np.uint32)
        rows = []
        for t in texts_as_bytes(texts):
            numbers = word_numbers(words_of(t))
            found = [seeds[_passes(seeds, bits)] for seeds in (rolling(numbers, n) for n in lengths)]
            rows.append(np.unique(np.concatenate([np.empty(0, np.uint64), *found])).view(np.int64))
        return pa.array(rows, pa.list_(pa.int64()))

    return sift.asNondeterministic()  # else Spark sifts once for the filter on the seeds, and again for them


def _tiled(batch: pa.RecordBatch) -> dict[str, object]:
    texts, tests = (texts_as_bytes(batch.column(n)) for n in ("_text", "_test"))
    found = []
    for text, test in zip(texts, tests):
        words = words_of(test)
        marked = tiles(words_of(text), words, max(tile_words(words), 1))
        covered = sum(length for *_, length in marked)
        found.append((covered, len(words), len(marked), max((length for *_, length in marked), default=0)))
    covered, whole, n, longest = zip(*found) if found else ((), (), (), ())
    return {
        **{c: batch.column(c) for c in (*KEY, "item_id")},
        "matched_words": pa.array(covered, pa.int64()),
        "test_words": pa.array(whole, pa.int64()),
        "n_tiles": pa.array(n, pa.int64()),
        "longest_tile": pa.array(longest, pa.int64()),
    }


#: What stands for a text: 128 bits, so that equal texts are judged once and verdicts find them again.
KEY = ("_key1", "_key2")

_MATCH = (
    "_key1 bigint, _key2 bigint, item_id bigint, matched_words bigint, test_words bigint, n_tiles bigint, longest_tile bigint"
)


def with_key(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.withColumns({"_key1": F.xxhash64(text), "_key2": F.xxhash64(F.lit("second"), text)})


def matches(docs: DataFrame, benchmark: DataFrame, coverage: float = 0.0) -> DataFrame:
    """Every distinct text of ``docs`` and test that share a seed, with their tiles' sums; written once.

    Texts that share no seed with any test, nearly all, are sifted out where they lie by a bitmap of
    fixed size; what it lets through by chance has no partner in the join. The others are reduced to
    one row per text, and seeds meet in a join on their hash: a seed that many texts share is a
    large key of it, which adaptive execution splits. Pairs are distinct, at most one per text and test.

    With ``coverage``, pairs that cannot reach it are left out before texts move: a tile of t words
    holds at least t / l seeds of l words, so of a test of m words at least coverage * m / l places
    begin a shared seed. A common opening therefore brings no text to the tests that share only it.
    """
    numbered = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("_test"))
    tests = cut(numbered.withColumn("_test_no", F.monotonically_increasing_id()))
    seeds = cut(tests.select("_test_no", F.inline(_seeds(F.col("_test")))))
    lengths = sorted(r["least"] for r in seeds.select("least").distinct().collect())  # at most TILE of them
    sift = _sifted(_sieve(seeds), lengths)
    passed = docs.select("text", sift(F.col("text")).alias("_seeds")).where(F.size("_seeds") > 0)
    rows = cut(with_key(passed).dropDuplicates(list(KEY)))
    asked = rows.select(*KEY, F.explode("_seeds").alias("seed"))
    shared = asked.join(seeds, "seed").groupBy(*KEY, "_test_no")
    shared = shared.agg(F.sum("n").alias("_n"), F.max("words").alias("_words"), F.max("least").alias("_least"))
    pairs = shared.where(F.col("_n") * F.col("_least") >= F.lit(coverage) * F.col("_words")).select(*KEY, "_test_no")
    both = pairs.join(rows.select(*KEY, F.col("text").alias("_text")), list(KEY)).join(tests, "_test_no")
    return cut(map_batches(both.select(*KEY, "item_id", "_text", "_test"), _tiled, _MATCH))


def _is_hit(coverage: float) -> F.Column:
    return F.col("matched_words") >= F.lit(coverage) * F.col("test_words")


def contamination(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """One row per document: ``doc_id``, ``contaminated``, ``coverage``, ``n_items``, ``item_ids``.

    A document is contaminated by a test if tiles of at least 5 words, in any order, cover at least
    ``coverage`` of the test's words; a test of fewer words must stand in it as a whole. Bytes from 128
    on count as letters, so a run of a script without spaces is one word. ``coverage`` is the largest share found for any test that
    shares a seed (0 if none does), ``item_ids`` the sorted ids of the contaminating tests.
    ``docs`` needs ``doc_id`` and ``text``; NULL and empty texts are clean. Repeated rows are
    judged one by one, repeated tests count each, tests without id contaminate without being
    listed. Tests without words match nothing. No documents give no
    rows; without tests all are clean.
    """
    hit = _is_hit(coverage)
    found = cut(
        matches(docs, benchmark)
        .groupBy(*KEY)
        .agg(
            F.max(F.col("matched_words") / F.col("test_words")).alias("_share"),
            F.sum(hit.cast("bigint")).alias("_n"),
            F.sort_array(F.collect_set(F.when(hit, F.col("item_id")))).alias("_items"),
        )
    )
    keyed = with_key(docs.select("doc_id", "text")).select("doc_id", *KEY)
    return keyed.join(found, list(KEY), "left").select(
        "doc_id",
        (F.coalesce("_n", F.lit(0)) > 0).alias("contaminated"),
        F.coalesce("_share", F.lit(0.0)).alias("coverage"),
        F.coalesce("_n", F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("_items", F.array().cast("array<bigint>")).alias("item_ids"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The documents that no test contaminates, in the columns of ``docs``, whatever their names.

    The contaminated texts' keys are written, so that Spark can broadcast them if they are few and
    the documents stay where they are.
    """
    hits = cut(matches(docs, benchmark, coverage).where(_is_hit(coverage)).select(*KEY).distinct())
    clean = with_key(packed(docs, ["text"])).join(hits, list(KEY), "left_anti")
    return clean.select(*unpacked(clean, docs.columns, ["text"]))
