"""Spelling variants: words one edit apart, found on a trie whose levels are tables."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from tierkeep.llm.batches import texts_as_bytes
from tierkeep.session import cut

#: Code points of the shortest word, fewest occurrences of a word, and how much more frequent a word's form is.
SHORTEST, LEAST, TIMES = 7, 2, 10

#: One run of a word in so many has a code point deleted, as a test of what is found.
SPOILT = 31

#: Words that a task holds when it counts.
COUNTED = 1 << 20

_RUN = re.compile(f"[a-zÀ-ÿ]{{{SHORTEST},}}")
_LOWER = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))


def runs_of(text: bytes) -> list[str]:
    """Maximal runs of letters of at least ``SHORTEST``, A-Z lower-cased; the letters are a-z and U+00C0 to U+00FF."""
    return _RUN.findall(text.translate(_LOWER).decode())


def spoilt(run: str, doc_id: str) -> str:
    """The run as it counts for a document: by crc32 of ``<doc_id>:<run>`` with or without one of its code points."""
    h = zlib.crc32(run.encode(), zlib.crc32(f"{doc_id}:".encode()))
    if h % SPOILT:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _word_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()

    def flushed() -> pa.RecordBatch:
        columns = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["word", "n"])

    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        for doc_id, text in zip(ids, texts_as_bytes(batch.column("text"))):
            for run, n in Counter(runs_of(text)).items():
                word = spoilt(run, doc_id or "")
                if len(word) >= SHORTEST:
                    counts[word] += n
            if len(counts) > COUNTED:
                yield flushed()
                counts.clear()
    yield flushed()


def words(docs: DataFrame) -> DataFrame:
    """``word`` and its occurrences ``n`` over all documents, for words of at least ``LEAST`` occurrences; not written."""
    named = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    counted = named.mapInArrow(_word_counts, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= LEAST)


def _char(word: str, place: Column | int) -> Column:
    """The code point at a place from 0; empty beyond the end."""
    return F.substring(F.col(word), F.lit(place) + 1 if isinstance(place, int) else place + 1, F.lit(1))


def _part(word: str, place: Column, size: Column) -> Column:
    """``size`` code points from a place on, fewer if the word ends before."""
    return F.substring(F.col(word), place + 1, size)


@F.arrow_udf(IntegerType())
def _agreeing(a: pa.Array, b: pa.Array) -> pa.Array:
    """Code points that two words have in common at their beginnings; NULL if there is only one."""
    pairs = zip(a.to_pylist(), b.to_pylist())
    return pa.array([None if y is None else len(commonprefix((x, y))) for x, y in pairs], pa.int32())


_PAIR = ["word", "other"]


def near_words(words: DataFrame) -> DataFrame:
    """``word`` and ``other``, both ways, for all words that differ by one inserted, deleted or replaced code point.

    ``words`` has distinct ``word``. Each word lies on two tries, as it is and turned round, whose edges
    of one level after the other are a table (node, first code point, child, depth of the child). A
    chain of nodes without branches is one edge, labelled with what all words below it have in common.
    A frontier of states (word, position, node, edits) goes down with it. On the word's own path (no
    edit yet) a state is born wherever the word's next code point is left out, or another edge with a
    higher first code point is taken instead of it, if that lies in the word's second half: for the
    first half the turned word does it. So nothing is born near the root, where all words lie close
    together. Born states (one edit) only follow edges that agree with the word. A state at the end of
    its word and at a node where a word ends makes the two neighbours. An insertion is the other
    word's deletion, and a replacement by a lower code point the other word's, so every pair comes up
    from one side; of a run of equal code points only the last is left out. Between branches no edit
    can lead to another word.

    An edge with a single word below is followed to that word's end at once. So there are as many
    levels as branches lie behind one another, however long words are. Every level is written. Edges
    are one row each, and a word has at most as many states as its nodes have edges, of which there
    are fewer than letters; so no group is paired with itself. Nodes are 64-bit hashes, and pairs are
    checked at the end.
    """
    # words on the tries whose node at this level has other words below it, too; edits count from "half" on
    size = F.length("word")
    way = lambda text, half, turned: F.struct(
        text.alias("word"), half.cast("int").alias("half"), F.lit(int(turned)).cast("bigint").alias("node"), F.lit(turned).alias("turned")
    )
    ways = F.array(way(F.col("word"), F.floor(size / 2), False), way(F.reverse("word"), F.ceil(size / 2), True))
    alive = cut(words.select(size.alias("size"), F.lit(0).alias("depth"), F.inline(ways)))
    states, found = None, []
    while not alive.isEmpty():
        onward = alive.where(F.col("size") > F.col("depth")).withColumn("char", _char("word", F.col("depth")))
        ended = alive.where(F.col("size") == F.col("depth")).select(F.col("node").alias("_at"), F.col("word").alias("other"))
        edges = onward.groupBy("node", "char").agg(
            F.count("*").alias("_below"), F.min("word").alias("_one"), F.max("word").alias("_last"), F.min("depth").alias("_depth")
        )
        shared = _agreeing("_one", F.when(F.col("_below") > 1, F.col("_last")))
        reach = F.coalesce(shared, F.length("_one"))
        taken = cut(
            edges.select(
                F.col("node").alias("_at"), F.col("char").alias("_char"), "_below", "_one", "_depth", reach.alias("_reach"),
                F.xxhash64("node", "char").alias("_child"),
            )
        )

        # what is still to be compared: the word from "position" on, the edge's words from "_from" on
        bearing = onward.where(F.col("depth") >= F.col("half"))
        replaced = bearing.join(taken, (F.col("node") == F.col("_at")) & (F.col("_char") > F.col("char")))
        replaced = replaced.withColumns({"position": F.col("depth") + 1, "_from": F.col("_depth") + 1})
        left_out = bearing.where(F.col("char") != _char("word", F.col("depth") + 1))
        front = left_out.select("word", "size", (F.col("depth") + 1).alias("position"), "node", "turned")
        front = front if states is None else front.unionByName(states)
        asked = front.where(F.col("position") < F.col("size")).withColumn("char", _char("word", F.col("position")))
        stepped = asked.join(taken, (F.col("node") == F.col("_at")) & (F.col("char") == F.col("_char")))
        stepped = stepped.withColumn("_from", F.col("_depth"))
        columns = ["word", "size", "position", "turned", "_from", "_below", "_one", "_reach", "_child"]
        moved = replaced.select(*columns).unionByName(stepped.select(*columns))
        left = F.col("_reach") - F.col("_from")
        alone = F.col("_below") == 1
        whole = ~alone | (F.col("size") - F.col("position") == left)
        agrees = whole & (_part("word", F.col("position"), left) == _part("_one", F.col("_from"), left))
        moved = moved.where(agrees).select(
            "word", "size", (F.col("position") + left).alias("position"), F.col("_child").alias("node"), "turned",
            F.when(alone, F.col("_one")).alias("other"),
        )
        arrived = front.where(F.col("position") == F.col("size")).join(ended, F.col("node") == F.col("_at"))
        level = cut(moved.unionByName(arrived.select("word", "size", "position", "node", "turned", "other")))
        made = level.where(F.col("other").isNotNull())
        found.append(made.select(*(F.when(F.col("turned"), F.reverse(c)).otherwise(F.col(c)).alias(c) for c in _PAIR)))
        states = level.where(F.col("other").isNull()).select("word", "size", "position", "node", "turned")

        following = taken.where("_below > 1")
        alive = onward.join(following, (F.col("node") == F.col("_at")) & (F.col("char") == F.col("_char")))
        alive = cut(alive.select("word", "size", "half", "turned", F.col("_reach").alias("depth"), F.col("_child").alias("node")))
    if not found:
        return words.select("word", F.col("word").alias("other")).where(F.lit(False))
    # no node with two words below is left, and so no state
    pairs = reduce(DataFrame.unionByName, found)
    pairs = pairs.where((F.col("word") != F.col("other")) & (F.levenshtein("word", "other", 1) == 1))
    return pairs.union(pairs.select("other", "word")).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` for words with a form, by joining the table with itself until nothing moves.

    A form is more frequent than its word, so there are no cycles, and each round doubles the steps.
    """
    now = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = now.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        joined = now.join(onward, F.col("root") == F.col("_word"), "left")
        after = cut(joined.select("word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("_moved")))
        now = after.select("word", "root")
        if after.where("_moved").isEmpty():
            return now


def variants(docs: DataFrame, times: int = TIMES) -> DataFrame:
    """One row per word: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    Words are the letter runs of whole texts (``runs_of``, ``spoilt``) with at least ``SHORTEST`` code
    points and ``LEAST`` occurrences. Words one edit apart are near. A word's form is its most
    frequent near word (the first in code-point order of equal ones) if that is at least ``times`` as
    frequent; forms are followed to the ``root``, which is the word itself if it has none.

    NULL and empty texts have no words; a NULL id counts as an empty text in ``spoilt``. Repeated
    rows count each. Texts and words may have any length. No words give no rows. Columns other than
    ``doc_id`` and ``text`` are not read.
    """
    counted = cut(words(docs))
    pairs = near_words(counted.select("word"))
    others = counted.select(F.col("word").alias("_other"), F.col("n").alias("_n"))
    first = F.struct((-F.col("_n")).alias("less"), F.col("_other").alias("word"))
    about = pairs.join(others, F.col("other") == F.col("_other")).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(first).alias("_best")
    )
    about = about.withColumnRenamed("word", "_word")
    rows = counted.join(about, F.col("word") == F.col("_word"), "left")
    formed = -F.col("_best.less") >= times * F.col("n")
    rows = cut(
        rows.select(
            "word",
            F.when(formed, F.col("_best.word")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(formed, -F.col("_best.less")).alias("form_n"),
        )
    )
    roots = _roots(rows.where(F.col("form").isNotNull())).withColumnRenamed("word", "_word")
    rows = rows.join(roots, F.col("word") == F.col("_word"), "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
