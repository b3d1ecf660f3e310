"""A quality classifier: a generalised additive model with pairwise interactions.

The score is a logistic function of a sum of lookup tables, one per feature and one per chosen pair
of features. Shallow trees over binned features, boosted in turn, fill the tables; scoring adds up
the bins' values.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from tierkeep.llm.batches import texts_as_bytes
from tierkeep.llm.packing import packed, unpacked
from tierkeep.session import cut

#: Numbers taken from a text, in this order.
FEATURES = (
    "log_bytes", "log_words", "mean_word_bytes", "max_word_bytes", "upper_share", "digit_share", "symbol_share",
    "punctuation_share", "exclamation_share", "bar_share", "wide_share", "distinct_word_share", "repeated_next_share",
    "top_word_share", "distinct_line_share", "mean_line_words", "marked_word_share", "upper_word_share",
)

#: Labelled rows that a model is fitted on at most.
SAMPLE = 20_000

#: Documents that score lower are predicted to be of low quality.
CUTOFF = 0.3

_SPACES = b" \t\n\x0b\x0c\r"


def text_features(text: bytes) -> list[float]:
    """``FEATURES`` of a whole text; all 0 for an empty one."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    solid = max(1, int(counts.sum() - counts[list(_SPACES)].sum()))

    def share(chars: bytes) -> float:
        return float(counts[list(chars)].sum()) / solid

    n = len(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    lines = [line for line in text.split(b"\n") if line.strip()]
    same_next = sum(map(bytes.__eq__, words, words[1:]))
    marked = sum(w[-1] in b"#*$%&|<>!" for w in words)
    upper = sum(map(bytes.isupper, words))
    return [
        float(np.log1p(len(text))),
        float(np.log1p(n)),
        float(lengths.mean()),
        float(lengths.max()),
        float(counts[65:91].sum()) / solid,
        float(counts[48:58].sum()) / solid,
        share(b"#*$%&<>@^~=+_{}[]\\"),
        share(b".,;:?'\"-()"),
        share(b"!"),
        share(b"|"),
        float(counts[128:].sum()) / solid,
        len(seen) / n,
        same_next / n,
        max(seen.values()) / n,
        len(set(lines)) / len(lines),
        n / len(lines),
        marked / n,
        upper / n,
    ]


@F.arrow_udf(ArrayType(FloatType()))
def features(texts: pa.Array) -> pa.Array:
    """``FEATURES`` of every text; NULL counts as empty."""
    return pa.array([text_features(t) for t in texts_as_bytes(texts)], pa.list_(pa.float32()))


@dataclass(frozen=True)
class AdditiveModel:
    """Bin edges and lookup tables; a few thousand numbers, whatever the size of the corpus."""

    base: float
    edges: tuple[np.ndarray, ...]
    tables: tuple[np.ndarray, ...]
    pairs: tuple[tuple[int, int], ...]
    pair_tables: tuple[np.ndarray, ...]

    def bins(self, rows: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, rows[:, f], side="right") for f, e in enumerate(self.edges)], axis=1)

    def margins(self, rows: np.ndarray) -> np.ndarray:
        bins = self.bins(rows)
        total = np.full(len(rows), self.base)
        for f, table in enumerate(self.tables):
            total += table[bins[:, f]]
        for (f, g), table in zip(self.pairs, self.pair_tables):
            total += table[bins[:, f], bins[:, g]]
        return total

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.margins(rows)))


def _sums(bins: np.ndarray, size: int, gradient: np.ndarray, hessian: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.bincount(bins, gradient, size), np.bincount(bins, hessian, size)


def _gain(g: np.ndarray, h: np.ndarray, penalty: float) -> np.ndarray:
    return g * g / (h + penalty)


def _leaf_values(g: np.ndarray, h: np.ndarray, leaves: int, penalty: float) -> np.ndarray:
    """A tree of at most ``leaves`` leaves over the bins of one feature, as a value per bin.

    The cut that gains most is made first, then the best within any leaf.
    """
    spans = [(0, len(g))]
    while len(spans) < leaves:
        best = (1e-9, None, None)
        for s, (a, b) in enumerate(spans):
            if b - a < 2:
                continue
            gl, hl = np.cumsum(g[a : b - 1]), np.cumsum(h[a : b - 1])
            gs, hs = g[a:b].sum(), h[a:b].sum()
            gains = _gain(gl, hl, penalty) + _gain(gs - gl, hs - hl, penalty) - _gain(gs, hs, penalty)
            at = int(gains.argmax())
            if gains[at] > best[0]:
                best = (gains[at], s, a + at + 1)
        if best[1] is None:
            break
        a, b = spans.pop(best[1])
        spans += [(a, best[2]), (best[2], b)]
    values = np.zeros(len(g))
    for a, b in spans:
        values[a:b] = g[a:b].sum() / (h[a:b].sum() + penalty)
    return values


def _quadrants(g: np.ndarray, h: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """The best tree that cuts a pair of features once each: its gain, and its value per cell."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    rows, columns = g.shape[0] - 1, g.shape[1] - 1
    if rows < 1 or columns < 1:
        return 0.0, np.zeros_like(g)

    def four(c: np.ndarray) -> list[np.ndarray]:
        top, left, corner = c[:-1, -1:], c[-1:, :-1], c[:-1, :-1]
        return [corner, top - corner, left - corner, c[-1, -1] - top - left + corner]

    gain = sum(_gain(x, y, penalty) for x, y in zip(four(cg), four(ch))) - _gain(cg[-1, -1], ch[-1, -1], penalty)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    values = np.zeros_like(g)
    for r in (slice(0, i + 1), slice(i + 1, None)):
        for c in (slice(0, j + 1), slice(j + 1, None)):
            values[r, c] = g[r, c].sum() / (h[r, c].sum() + penalty)
    return float(gain[i, j]), values


def fit(
    rows: np.ndarray,
    labels: np.ndarray,
    bins: int = 32,
    rounds: int = 150,
    pairs: int = 8,
    rate: float = 0.1,
    leaves: int = 4,
    penalty: float = 5.0,
) -> AdditiveModel:
    """Boost the features in turn, ``rounds`` times; then the ``pairs`` of features whose quadrants explain most of the rest.

    Features are cut into at most ``bins`` bins at quantiles. Without rows, or with one class only,
    the model is a constant.
    """
    n, width = rows.shape
    positive = float(labels.sum())
    base = float(np.log((positive + 1.0) / (n - positive + 1.0)))
    quantiles = np.linspace(0, 1, bins + 1)[1:-1]
    edges = tuple(np.unique(np.quantile(rows[:, f], quantiles)) if n else np.empty(0) for f in range(width))
    tables = [np.zeros(len(e) + 1) for e in edges]
    if positive in (0.0, float(n)):
        return AdditiveModel(base, edges, tuple(tables), (), ())
    empty = AdditiveModel(base, edges, tuple(tables), (), ())
    at = empty.bins(rows)
    margin = np.full(n, base)

    def pulls() -> tuple[np.ndarray, np.ndarray]:
        p = 1.0 / (1.0 + np.exp(-margin))
        return labels - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for f in range(width):
            gradient, hessian = pulls()
            step = rate * _leaf_values(*_sums(at[:, f], len(tables[f]), gradient, hessian), leaves, penalty)
            tables[f] += step
            margin += step[at[:, f]]

    def cells(f: int, g: int) -> tuple[np.ndarray, tuple[int, int]]:
        return at[:, f] * len(tables[g]) + at[:, g], (len(tables[f]), len(tables[g]))

    gradient, hessian = pulls()
    ranked = []
    for f in range(width):
        for g in range(f + 1, width):
            flat, shape = cells(f, g)
            sums = _sums(flat, shape[0] * shape[1], gradient, hessian)
            ranked.append((_quadrants(*(s.reshape(shape) for s in sums), penalty)[0], f, g))
    chosen = [(f, g) for gain, f, g in sorted(ranked, reverse=True)[:pairs] if gain > 0]
    pair_tables = [np.zeros((len(tables[f]), len(tables[g]))) for f, g in chosen]
    for _ in range(rounds // 2):
        for k, (f, g) in enumerate(chosen):
            gradient, hessian = pulls()
            flat, shape = cells(f, g)
            sums = _sums(flat, shape[0] * shape[1], gradient, hessian)
            step = rate * _quadrants(*(s.reshape(shape) for s in sums), penalty)[1]
            pair_tables[k] += step
            margin += step.ravel()[flat]
    return AdditiveModel(base, edges, tuple(tables), tuple(chosen), tuple(pair_tables))


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Whether a document's labels are kept from learning; a NULL id is."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, **options) -> AdditiveModel:
    """Fit on the labelled documents that are not held out: the ``sample`` of them whose id hashes lowest.

    Labels without id or quality do not count; of several for one document the lowest does. At most
    ``sample`` ids and labels, and as many rows of features, come to the driver; the rule is the same
    for every size of corpus. Documents whose id repeats count each.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("_quality"))
    drawn = known.where(~held_out()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    drawn = cut(drawn.select(F.col("doc_id").alias("_doc_id"), "_quality"))
    # at most ``sample`` pairs of numbers: a bounded broadcast, so the texts need not move
    labelled = docs.select("doc_id", "text").join(F.broadcast(drawn), F.col("doc_id") == F.col("_doc_id"))
    taken = labelled.select("doc_id", features(F.col("text")).alias("x"), "_quality").toPandas()
    taken = taken.sort_values(["doc_id"], kind="stable")
    rows = np.array(taken["x"].tolist(), np.float64).reshape(-1, len(FEATURES))
    return fit(rows, (taken["_quality"].to_numpy() >= 1).astype(np.float64), **options)


def with_score(docs: DataFrame, model: AdditiveModel, name: str = "score") -> DataFrame:
    """``docs`` with the model's score of ``text`` (0 to 1, higher: better); NULL counts as empty."""

    @F.arrow_udf(DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        found = np.array([text_features(t) for t in texts_as_bytes(texts)], np.float32).astype(np.float64)
        return pa.array(model.scores(found.reshape(-1, len(FEATURES))), pa.float64())

    return docs.withColumn(name, score(F.col("text")))


def accepted(docs: DataFrame, model: AdditiveModel, cutoff: float = CUTOFF) -> DataFrame:
    """The documents that score at least ``cutoff``, in the columns of ``docs``, whatever their names."""
    scored = with_score(packed(docs, ["text"]), model, "_score").where(F.col("_score") >= cutoff)
    return scored.select(*unpacked(scored, docs.columns, ["text"]))
