"""Quality rules whose cutoffs are certified on labelled holdouts. DataFrame operations only.

A rule rejects a document whose measure lies above the cutoff of the document's stratum. Cutoffs are
used only if an exact binomial test on the stratum's good documents shows that all rules together
reject at most the allowed share of them. They are tested along one fixed path from lenient to
strict, on which the rules become stricter in turn, and testing stops at the first failure, so the
number of steps costs nothing; strata share the error probability evenly (Bonferroni).

One more stratum, of all good documents together, is tested in the same way. Where a stratum has too
few good documents for any test to pass, its documents are judged by the cutoffs of that coarser
stratum, and ``certified_on`` says so: they hold for all good documents as a whole, not for the
stratum's own.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierkeep.session import cut

SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"

#: Measures, and the cutoffs that are tried from lenient to strict.
RULES: dict[str, tuple[float, ...]] = {
    "symbol_share": (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02),
    "dup_line_share": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1),
    "repeat_share": (0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1),
    "mean_word_chars": (20.0, 18.0, 16.0, 14.0, 12.0, 11.0, 10.0, 9.0),
}

COUNTS = ("doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines")

#: Share of good documents that all rules together may reject, and the chance that this fails anywhere.
RISK, ERROR = 0.02, 0.05

#: Rules that the joint path tightens only after all others: the base rule rejects most of what they do.
LAST = ("repeat_share",)


def path(rules: Mapping[str, Sequence[float]]) -> list[tuple[str, float]]:
    """The steps (rule, its new cutoff) of the joint path: rules advance in turn, by equal shares of their cutoffs."""
    steps = [(r in LAST, (i + 1) / len(cutoffs), n, r, c) for n, (r, cutoffs) in enumerate(rules.items()) for i, c in enumerate(cutoffs)]
    return [(r, c) for *_, r, c in sorted(steps)]


def least_good(risk: float, error: float) -> int:
    """Good documents below which no cutoff can pass a test, even if it rejects none of them."""
    return math.ceil(math.log(error) / math.log1p(-risk))


def _windows(hashes: Column) -> Column:
    """The 3-word windows as (h, i): a hash of the words' hashes, and the place of the first word.

    Two different windows of one text share a 64-bit hash with a probability of about n^2 / 2^65.
    """

    def rest(start: int) -> Column:
        return F.slice(hashes, start, F.greatest(F.size(hashes) - (start - 1), F.lit(0)))

    zipped = F.arrays_zip(rest(1).alias("a"), rest(2).alias("b"), rest(3).alias("c"))
    windows = F.transform(zipped, lambda w, i: F.struct(F.xxhash64(w["a"], w["b"], w["c"]).alias("h"), i.alias("i")))
    return F.slice(windows, 1, F.greatest(F.size(hashes) - 2, F.lit(0)))


def _covered(places: Column) -> Column:
    """Length of the union of [p, p + 3) over sorted places."""
    return F.aggregate(
        places,
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).alias("last")),
        lambda s, p: F.struct((s["n"] + F.least(F.lit(3), p - s["last"])).alias("n"), p.alias("last")),
        lambda s: s["n"],
    )


def measured(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``lang``, ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_lines`` (with a word), ``n_dup_lines``, ``n_repeat_words`` (bigint). NULL and empty texts count 0 of everything."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = docs.select("doc_id", "lang", text.alias("_text"))
    words = words.select(
        "doc_id",
        "lang",
        F.length(F.regexp_replace("_text", SPACE, "")).cast("bigint").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", "#*$%&|<>", ""))).cast("bigint").alias("n_symbols"),
        F.filter(F.split("_text", "\n"), lambda x: x.rlike(NOT_SPACE)).alias("_lines"),
        F.transform(F.array_remove(F.split("_text", SPACE), ""), lambda w: F.xxhash64(w)).alias("_hashes"),
    )
    words = words.select(
        "doc_id",
        "lang",
        F.size("_hashes").cast("bigint").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.sort_array(_windows(F.col("_hashes"))).alias("_windows"),
    )

    def again(window: Column, i: Column) -> Column:
        before = F.get(F.col("_windows"), i - 1)["h"] == window["h"]
        after = F.get(F.col("_windows"), i + 1)["h"] == window["h"]
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    places = F.sort_array(F.transform(F.filter("_windows", again), lambda w: w["i"]))
    return words.select(*COUNTS, places.alias("_places")).select(
        *COUNTS, _covered(F.col("_places")).alias("n_repeat_words")
    )


def with_measures(counted: DataFrame) -> DataFrame:
    """The measures of ``RULES`` from the counts of ``measured``; a text without words has 0 of each."""

    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))

    return counted.withColumns(
        {
            "symbol_share": share("n_symbols", "word_chars"),
            "dup_line_share": share("n_dup_lines", "n_lines"),
            "repeat_share": share("n_repeat_words", "n_words"),
            "mean_word_chars": share("word_chars", "n_words"),
        }
    )


def binomial_tail(n: Column, k: Column, rate: float) -> Column:
    """P(X <= k) for X binomial with ``n`` trials at ``rate``; 1 for k above n * rate, where no test can pass.

    Terms follow from one another in logarithms, so that many trials do not underflow.
    """
    odds = math.log(rate) - math.log1p(-rate)
    first = n * F.lit(math.log1p(-rate))
    tail = F.aggregate(
        F.when(k > 0, F.sequence(F.lit(1).cast("bigint"), k)).otherwise(F.array().cast("array<bigint>")),
        F.struct(first.alias("t"), F.exp(first).alias("p")),
        lambda s, i: F.struct(
            (s["t"] + F.log((n - i + 1) / i) + F.lit(odds)).alias("t"),
            (s["p"] + F.exp(s["t"] + F.log((n - i + 1) / i) + F.lit(odds))).alias("p"),
        ),
        lambda s: s["p"],
    )
    return F.when(k > n * F.lit(rate), F.lit(1.0)).otherwise(tail)


def certified_cutoffs(
    measures: DataFrame,
    labels: DataFrame,
    rules: Mapping[str, Sequence[float]] = RULES,
    risk: float = RISK,
    error: float = ERROR,
) -> DataFrame:
    """One row per stratum that has good documents: ``stratum``, ``certified_on`` and a column per rule, NULL where nothing is certified.

    ``measures`` has ``doc_id``, ``lang`` (the stratum; NULL is one) and the rules' measures. A
    document is good if all its labels have quality 1; labels without id or quality do not count.
    Rows of one id and the same measures are one trial. ``certified_on`` is ``own``, or ``all`` for
    strata with fewer good documents than ``least_good(risk, error / (strata + 1))``, whose cutoffs
    are those certified on all good documents together.
    One aggregation over the labelled rows; what follows has one row per stratum and step.
    """
    good = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("_q"))
    holdout = measures.select("doc_id", "lang", *rules).join(good.where("_q = 1").select("doc_id"), "doc_id").distinct()
    reached: dict[str, float] = {}
    steps = []
    for i, (r, c) in enumerate(path(rules)):
        reached[r] = c
        rejected = reduce(Column.__or__, (F.col(x) > F.lit(y) for x, y in reached.items()))
        steps.append((r, c, F.sum(rejected.cast("bigint")).alias(f"_k{i}")))
    sums = ["n", *(f"_k{i}" for i in range(len(steps)))]
    counted = holdout.groupBy(F.col("lang").alias("stratum")).agg(F.count("*").alias("n"), *(k for *_, k in steps))
    counted = cut(counted.select("stratum", F.lit(False).alias("_all"), *sums))
    whole = counted.groupBy(F.lit(None).cast("string").alias("stratum"), F.lit(True).alias("_all")).agg(*(F.sum(c).alias(c) for c in sums))
    # all strata and the coarser one are as many rows as there are tests
    tested = counted.union(whole).withColumn("_allowed", F.lit(error) / F.count("*").over(Window.partitionBy()))
    tests = F.array(
        *(
            F.struct(F.lit(i).alias("step"), F.lit(r).alias("rule"), F.lit(c).alias("cutoff"), F.col(f"_k{i}").alias("k"))
            for i, (r, c, _) in enumerate(steps)
        )
    )
    tested = tested.select("stratum", "_all", "n", "_allowed", F.explode(tests).alias("t")).select("stratum", "_all", "n", "_allowed", "t.*")
    tested = tested.withColumn("_p", binomial_tail(F.col("n"), F.col("k"), risk))
    so_far = Window.partitionBy("_all", "stratum").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    tested = tested.withColumn("_passed", F.max("_p").over(so_far) <= F.col("_allowed"))
    found = tested.groupBy("_all", "stratum").agg(
        (F.exp(F.max("n") * F.lit(math.log1p(-risk))) <= F.max("_allowed")).alias("_enough"),
        *(F.min(F.when((F.col("rule") == r) & F.col("_passed"), F.col("cutoff"))).alias(r) for r in rules),
    )
    coarser = {r: F.max(F.when(F.col("_all"), F.col(r))).over(Window.partitionBy()) for r in rules}
    found = found.select(
        "stratum",
        "_all",
        F.when(F.col("_enough"), F.lit("own")).otherwise(F.lit("all")).alias("certified_on"),
        *(F.when(F.col("_enough"), F.col(r)).otherwise(coarser[r]).alias(r) for r in rules),
    )
    return found.where("not _all").drop("_all")


def judged(
    docs: DataFrame,
    labels: DataFrame,
    rules: Mapping[str, Sequence[float]] = RULES,
    risk: float = RISK,
    error: float = ERROR,
) -> DataFrame:
    """One row per document: the counts of ``measured``, the rules' measures, ``base_failed``,
    ``failed_rules`` (sorted, comma-joined, empty if none), ``kept`` and ``certified_on`` (whose good
    documents the cutoffs are certified on: ``own`` stratum, ``all``, or NULL for the base rule only).

    The base rule fails a document with fewer than 50 words, or more than half of whose words stand
    in repeated windows. Documents of a stratum without good labelled documents, or for which nothing
    is certified, fail the base rule only. Repeated rows are judged each; long texts are measured whole;
    other columns are not read.
    No documents give no rows; without labels nothing is certified. Counts are taken once and
    written, as the cutoffs and the verdict both need them; texts are not.
    """
    measures = cut(with_measures(measured(docs)))
    cutoffs = cut(certified_cutoffs(measures, labels, rules, risk, error))
    renamed = cutoffs.select(F.col("stratum").alias("_stratum"), "certified_on", *(F.col(r).alias(f"_{r}") for r in rules))
    ruled = measures.join(renamed, F.col("lang").eqNullSafe(F.col("_stratum")), "left")
    failed = F.array_compact(F.array(*(F.when(F.col(r) > F.col(f"_{r}"), F.lit(r)) for r in sorted(rules))))
    few = F.col("n_words") < 50
    repetitive = F.col("n_repeat_words") * 100 > F.col("n_words") * 50
    return ruled.select(
        *measures.columns,
        (few | repetitive).alias("base_failed"),
        F.concat_ws(",", failed).alias("failed_rules"),
        (~(few | repetitive) & (F.size(failed) == 0)).alias("kept"),
        F.when(reduce(Column.__or__, (F.col(f"_{r}").isNotNull() for r in rules)), F.col("certified_on")).alias("certified_on"),
    )
