"""URL filters whose lists change over time. DataFrame operations only.

List changes become validity intervals, and every capture is judged by the entries that were active
when it was fetched. Entries name a whole URL, the first path segment of a host, a host, or a parent
domain; the most specific active entry decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierkeep.llm.packing import packed, unpacked
from tierkeep.session import cut

#: Keys of a URL from specific to general: URL, host and first segment, host, parent domains.
URL, SECTION, HOST, DOMAIN = 0, 1, 2, 3


def host(url: Column) -> Column:
    """Lower-case host of an absolute URL, without port and credentials; NULL if there is none."""
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.nullif(found, F.lit(""))


def section(url: Column) -> Column:
    """Host and first path segment (``host/segment``); NULL if the path is empty."""
    first = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)", 1)
    return F.when(first != "", F.concat(host(url), F.lit("/"), first))


def url_keys(url: Column) -> Column:
    """Every list key that covers a URL, as an array of (``rank``, ``key``); lower rank decides first.

    Parent domains have two labels or more; nearer parents rank before farther ones.
    """
    labels = F.split(host(url), r"\.")
    parents = F.transform(
        F.when(F.size(labels) > 2, F.sequence(F.lit(1), F.size(labels) - 2)).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(
            (F.lit(DOMAIN - 1) + i).alias("rank"),
            F.array_join(F.slice(labels, i + 1, F.size(labels)), ".").alias("key"),
        ),
    )
    own = F.array(
        *(
            F.struct(F.lit(rank).alias("rank"), key.alias("key"))
            for rank, key in ((URL, url), (SECTION, section(url)), (HOST, host(url)))
        )
    )
    return F.filter(F.concat(own, F.coalesce(parents, F.array().cast("array<struct<rank:int,key:string>>"))), lambda k: k["key"].isNotNull())


def validity_intervals(changes: DataFrame) -> DataFrame:
    """Dated list changes as intervals: ``key``, ``action`` (``block`` or ``allow``), ``valid_from``, ``valid_to``.

    ``changes`` has ``key``, ``action`` (``block``, ``allow``, or ``remove``, which ends the entry
    before it), ``changed_at`` (timestamp_ntz), and ``change_no``, which orders changes of the same
    moment: the last one counts. A change ends at the next one of its key that says something
    else; ``valid_to`` is exclusive, and NULL while the entry stands. Changes without key, time or
    known action are left out. The windows run over the changes of one key.
    """
    known = changes.where("key is not null and changed_at is not null and action in ('block', 'allow', 'remove')")
    known = known.select("key", "action", "changed_at", "change_no")
    by_key = Window.partitionBy("key").orderBy("changed_at", F.col("change_no").asc_nulls_first(), "action")
    known = known.withColumn("_next", F.lead("changed_at").over(by_key))
    known = known.where("_next is null or _next > changed_at").withColumn("_was", F.lag("action").over(by_key))
    known = known.where("_was is null or _was <> action")
    spans = known.select(
        "key", "action", F.col("changed_at").alias("valid_from"), F.lead("changed_at").over(by_key).alias("valid_to")
    )
    return spans.where("action <> 'remove'")


def _month(at: Column) -> Column:
    return F.year(at) * 12 + F.month(at)


def judged(captures: DataFrame, changes: DataFrame) -> DataFrame:
    """One row per capture: its columns, ``host``, and the entry that decides.

    ``captures`` has ``url`` and ``fetched_at`` (timestamp_ntz). New columns: ``verdict``
    (``block``, ``allow`` or ``unlisted``), ``rule`` (the deciding key), ``listed_from``,
    ``listed_to`` (NULL while the entry stands) and ``n_active`` (entries active for the capture);
    columns of these names are replaced. A capture without URL or time, or before any entry, is
    unlisted. Repeated captures stay. No captures give no rows.

    Captures and intervals meet on key and calendar month, so a capture sees only what changed
    about its key in its month; an interval has one row per month it touches, up to the month of the
    last capture. A host with a third of the captures is one large key of a sort-merge join, which
    adaptive execution splits. Captures are written once with a row number: the verdicts are
    brought back by it, so ids may repeat or be missing.
    """
    new = ("host", "verdict", "rule", "listed_from", "listed_to", "n_active")
    passing, read = captures.drop(*new), ["url", "fetched_at"]
    rows = cut(packed(passing, read).withColumn("_row", F.monotonically_increasing_id()))
    last = rows.agg(F.max(_month(F.col("fetched_at")))).first()[0]
    until = F.least(F.coalesce(_month(F.col("valid_to")), F.lit(last)), F.lit(last))
    starts = _month(F.col("valid_from"))
    months = F.when(starts <= until, F.sequence(starts, until))
    spans = validity_intervals(changes).withColumn("_month", F.explode(months))
    wanted = rows.select(
        "_row", "fetched_at", _month(F.col("fetched_at")).alias("_month"), F.explode(url_keys(F.col("url"))).alias("_k")
    ).select("_row", "fetched_at", "_month", F.col("_k.rank").alias("_rank"), F.col("_k.key").alias("key"))
    active = wanted.join(spans, ["key", "_month"]).where(
        (F.col("valid_from") <= F.col("fetched_at")) & (F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to")))
    )
    best = F.min(F.struct("_rank", "key", "action", "valid_from", "valid_to"))
    found = active.groupBy("_row").agg(best.alias("_best"), F.count("*").alias("_n"))
    return rows.join(found, "_row", "left").select(
        *unpacked(rows, passing.columns, read),
        host(F.col("url")).alias("host"),
        F.coalesce(F.col("_best.action"), F.lit("unlisted")).alias("verdict"),
        F.col("_best.key").alias("rule"),
        F.col("_best.valid_from").alias("listed_from"),
        F.col("_best.valid_to").alias("listed_to"),
        F.coalesce(F.col("_n"), F.lit(0)).cast("bigint").alias("n_active"),
    )
