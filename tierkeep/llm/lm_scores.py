"""Language-model scores of whole documents: counted on, and learnt from, all training documents."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierkeep.llm.batches import texts_as_bytes
from tierkeep.llm.recurrent import Learner, Model
from tierkeep.llm.simhash import words_of
from tierkeep.session import cut

#: Documents whose crc32(id) leaves this remainder are never learnt from.
FOLDS, HELD_OUT = 7, 2

#: Words that every task knows with their counts, at most, none of them longer than so many bytes; all others are joined.
KNOWN, LONGEST = 1 << 16, 64

#: Tokens that the model tells apart, besides all others together.
VOCABULARY = 767

#: Shares of the training documents, in 32ths, that one round of learning after another takes; weights are averaged after each.
ROUNDS = (2, 2, 4, 8, 16)

#: Tokens that a task holds when it scores or learns, as soon as it has so many; numbers of a block of weights.
LOT, BLOCK = 1 << 22, 1 << 13

#: Words that a task holds when it counts.
COUNTED = 1 << 20

#: The end of a document among the words.
END = b""


@dataclass(frozen=True)
class Counts:
    """Training counts: a written table (``word``, ``c``), its sums, and its most frequent words."""

    table: DataFrame
    tokens: int
    types: int
    words: list[bytes]
    counts: np.ndarray


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning; a NULL id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) == HELD_OUT


def _word_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def flushed() -> pa.RecordBatch:
        columns = [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["word", "c"])

    for batch in batches:
        for text in texts_as_bytes(batch.column(0)):
            counts.update(words_of(text))
            counts[END] += 1
            if len(counts) > COUNTED:
                yield flushed()
                counts.clear()
    yield flushed()


def count_words(texts: DataFrame) -> Counts:
    """Counts of all words of the column ``text`` and of one end for each row."""
    found = texts.select("text").mapInArrow(_word_counts, "word binary, c bigint")
    table = cut(found.groupBy("word").agg(F.sum("c").alias("c")))
    tokens, types = table.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    # the most frequent words by a histogram of few thousand bins, as sorting would send every task's first KNOWN to the driver
    short = table.where((F.length("word") <= LONGEST) & (F.col("word") != END))
    level = F.floor(F.log2("c") * 64)
    levels = sorted(short.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"])
    lowest, sum_of = None, 0
    for r in levels:
        sum_of += r["count"]
        if sum_of > KNOWN:
            break
        lowest = r["level"]
    frequent = F.lit(False) if lowest is None else level >= lowest
    rows = table.where((F.col("word") == END) | ((F.length("word") <= LONGEST) & frequent)).collect()
    rows.sort(key=lambda r: (-r["c"], bytes(r["word"])))
    words = [bytes(r["word"]) for r in rows]
    return Counts(table, tokens, types, words, np.array([r["c"] for r in rows], np.int64))


def vocabulary(counts: Counts, size: int = VOCABULARY) -> tuple[list[bytes], np.ndarray]:
    """The model's tokens from 1 on, and the counts of all, token 0 (any other word) first; the end is always in."""
    chosen = [i for i, w in enumerate(counts.words) if w != END][: size - 1]
    pairs = [(int(counts.counts[i]), counts.words[i]) for i in chosen]
    ends = next((int(c) for w, c in zip(counts.words, counts.counts) if w == END), 0)
    pairs = sorted([*pairs, (ends, END)], key=lambda p: (-p[0], p[1]))
    numbers = [c for c, _ in pairs]
    return [w for _, w in pairs], np.array([counts.tokens - sum(numbers), *numbers], np.int64)


_CODED = """row bigint, doc_id bigint, held_out boolean, slice int, n_tokens bigint, n_rare bigint, n_known bigint,
    log_all double, log_rare double, tail array<binary>, ids binary"""


def _coded(docs: DataFrame, known: Broadcast) -> DataFrame:
    """Documents as numbers of the model, with what the table of known words says about them; the other words as ``tail``."""

    def code(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts, chosen = known.value
        place = {w: i + 1 for i, w in enumerate(words)}
        logs = np.concatenate([[0.0], np.log10(counts + 1.0)])
        number = {w: i + 1 for i, w in enumerate(chosen)}
        model = np.zeros(len(words) + 1, np.uint16)
        model[1:] = [number.get(w, 0) for w in words]
        end = place.get(END, 0)
        names = ("n_tokens", "n_rare", "n_known", "log_all", "log_rare", "tail", "ids")
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                rows, out = batch.slice(start, 200), {n: [] for n in names}
                for text in texts_as_bytes(rows.column("text")):
                    own = words_of(text)
                    at = np.fromiter(map(place.get, own, repeat(0)), np.int64, len(own))
                    others = [own[i] for i in np.flatnonzero(at == 0).tolist()]
                    at = np.append(at, end)
                    ids = model[at]
                    if not end:
                        ids[-1] = number[END]
                    log, rare = logs[at], ids == 0
                    out["n_tokens"].append(len(at))
                    out["n_rare"].append(int(rare.sum()))
                    out["n_known"].append(int((at > 0).sum()))
                    out["log_all"].append(float(log.sum()))
                    out["log_rare"].append(float(log[rare].sum()))
                    out["tail"].append(others)
                    out["ids"].append(ids.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        *(rows.column(c) for c in ("row", "doc_id", "held_out", "slice")),
                        *(pa.array(out[n], pa.int64()) for n in names[:3]),
                        *(pa.array(out[n], pa.float64()) for n in names[3:5]),
                        pa.array(out["tail"], pa.list_(pa.binary())),
                        pa.array(out["ids"], pa.binary()),
                    ],
                    ["row", "doc_id", "held_out", "slice", *names],
                )

    lot = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(sum(ROUNDS))).cast("int")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        lot.alias("slice"),
        "text",
    )
    return cut(rows.mapInArrow(code, _CODED))


def _lots(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[tuple[list[pa.RecordBatch], list[np.ndarray]]]:
    """Batches put together until they have a lot of tokens, and their documents."""
    held, docs, size = [], [], 0
    for batch in batches:
        held.append(batch)
        for ids in batch.column(column):
            docs.append(np.frombuffer(ids.as_buffer(), np.uint16))
            size += len(docs[-1])
        if size >= LOT:
            yield held, docs
            held, docs, size = [], [], 0
    if docs:
        yield held, docs


def _round(ids: DataFrame, shared: Broadcast, model: Model) -> Model:
    """Every task learns from its documents, starting from the same model; the mean by tokens of what comes out.

    A task returns its weights in blocks of fixed size, which are added up block by block, so what
    one task or the driver holds is bounded by the model's size.
    """

    def learn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner = None
        for _, docs in _lots(batches, "ids"):
            if learner is None:
                start = shared.value
                learner = Learner(start.filled(start.flat()))
            learner.learn(docs)
        if learner is not None:
            flat, n = learner.model.flat(), learner.tokens
            blocks = [flat[i : i + BLOCK].tobytes() for i in range(0, len(flat), BLOCK)]
            columns = [pa.array(range(len(blocks)), pa.int32()), pa.array([n] * len(blocks), pa.int64()), pa.array(blocks, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["block", "n", "weights"])

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        tokens: Counter[int] = Counter()
        for batch in batches:
            for block, n, weights in zip(*(batch.column(c).to_pylist() for c in ("block", "n", "weights"))):
                values = np.frombuffer(weights, np.float32).astype(np.float64) * n
                sums[block] = sums[block] + values if block in sums else values
                tokens[block] += n
        columns = [pa.array(list(sums), pa.int32()), pa.array([tokens[b] for b in sums], pa.int64()),
                   pa.array([s.tobytes() for s in sums.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["block", "n", "weights"])

    kind = "block int, n bigint, weights binary"
    # in a fixed order, or sums would differ in their last digits from run to run
    parts = ids.mapInArrow(learn, kind).repartition("block").sortWithinPartitions("block", "n", "weights")
    rows = parts.mapInArrow(add, kind).collect()
    if not rows:
        return model
    rows.sort(key=lambda r: r["block"])
    return model.filled(np.concatenate([np.frombuffer(r["weights"], np.float64) / r["n"] for r in rows]))


def learnt(coded: DataFrame, counts: np.ndarray) -> Model:
    """A model learnt from all rows of ``coded`` that are not held out, each in one of the ``ROUNDS``."""
    model, first, context = Model.fresh(counts), 0, coded.sparkSession.sparkContext
    for share in ROUNDS:
        mine = coded.where(~F.col("held_out") & F.col("slice").between(first, first + share - 1)).select("ids")
        shared = context.broadcast(model)
        model = _round(mine, shared, model)
        shared.destroy()
        first += share
    return model


def scored(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Texts are lower-cased (A-Z) and cut at ASCII white space; a document's tokens are its words and
    one end. ``base_score`` adds up log10((c + 1) / (N + V + 1)) over them, with the training counts
    c, their sum N and the number V of different tokens; ``n_known`` counts tokens with c > 0.
    ``score`` is the recurrent model's log10 probability of the whole text. The model tells
    ``VOCABULARY`` tokens apart; any other word has the probability of "another word", times its
    share (c + 1) / (n + v + 1) of the n other tokens, v of them different.

    The model's size does not depend on the data. It is learnt from all documents that are not held
    out, each once: every task goes through its own part and the tasks' weights are averaged, in
    rounds of growing size. The most frequent words are broadcast (``KNOWN`` of at most ``LONGEST``
    bytes), the counts of all others come by a join.

    NULL and empty texts consist of an end. A repeated id is as many documents, with one verdict on
    ``held_out``; NULL ids are learnt from. Without training documents every count is 0. Texts of
    any length are scored whole, in time that grows with their length. Other columns are not read.
    """
    context = docs.sparkSession.sparkContext
    docs = docs.select("doc_id", "text")
    counts = count_words(docs.where(~held_out(F.col("doc_id"))))
    chosen, numbers = vocabulary(counts)
    known = context.broadcast((counts.words, counts.counts, chosen))
    coded = _coded(docs, known)
    model = context.broadcast(learnt(coded, numbers))

    tail = coded.where(F.size("tail") > 0).select("row", F.explode("tail").alias("word"))
    tail = tail.join(counts.table, "word", "left").groupBy("row").agg(
        F.sum(F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("_log"), F.count("c").alias("_known")
    )

    keep = ("row", "doc_id", "held_out", "n_tokens", "n_rare", "n_known", "log_all", "log_rare")

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, found in _lots(batches, "ids"):
            logs, at = model.value.log_likelihoods(found), 0
            for batch in held:
                own = logs[at : at + batch.num_rows]
                at += batch.num_rows
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(own)], [*keep, "ln"])

    kinds = "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_rare bigint, n_known bigint, log_all double, log_rare double, ln double"
    rows = coded.select(*keep, "ids").mapInArrow(judge, kinds).join(tail.withColumnRenamed("row", "_row"), F.col("row") == F.col("_row"), "left")
    extra = F.coalesce("_log", F.lit(0.0))
    all_types = counts.tokens + counts.types + 1
    named = len(chosen) if counts.tokens else 0
    other_types = int(numbers[0]) + counts.types - named + 1
    return rows.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(counts.tokens).cast("bigint").alias("train_tokens"),
        (F.col("log_all") + extra - F.col("n_tokens") * float(np.log10(all_types))).alias("base_score"),
        (F.col("ln") / float(np.log(10)) + F.col("log_rare") + extra - F.col("n_rare") * float(np.log10(other_types))).alias("score"),
    )
