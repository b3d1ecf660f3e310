"""The operators of this subpackage over whole tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierkeep.llm import (
    bit_planes,
    decontaminate,
    kd_shards,
    licenses,
    lm_scores,
    mixing,
    quality_model,
    quality_rules,
    simhash,
    spelling,
    token_counts,
    token_files,
    url_lists,
)
from tierkeep.session import cut

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql.strip()
        return build

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@_query("op1_license_scan")
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scanned(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "scan.*")


@_query("op2_additive_quality")
def op2_additive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model.learn(docs, _table(spark, sf_dir, "labels"))
    return quality_model.with_score(docs, model).select(
        "doc_id",
        quality_model.held_out().alias("held_out"),
        "score",
        (F.col("score") >= quality_model.CUTOFF).cast("int").alias("predicted"),
    )


@_query("op3_string_tiling")
def op3_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


# 4: URL filters. The tables hold neither fetch times nor lists, so both are derived from the pages:
# a fetch moment within a year per page, and four dated changes for each host, parent domain, section
# and every fourth URL.
_YEAR = 365 * 86400


def _number(text) -> F.Column:
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def _after_new_year(seconds: str) -> F.Column:
    return F.expr(f"timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, {seconds})")


def page_captures(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", _after_new_year(f"pmod(page_id * 104729, {_YEAR})").alias("fetched_at"))


def page_list_changes(pages: DataFrame) -> DataFrame:
    keys = pages.select(F.explode(url_lists.url_keys(F.col("url"))).alias("k")).select("k.rank", "k.key")
    keys = keys.where((F.col("rank") > 0) | (F.pmod(_number(F.col("key")), F.lit(4)) == 0)).select("key").distinct()
    dated = keys.select("key", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("change_no"))
    kind = F.pmod(_number(F.concat("key", F.lit("#"), F.col("change_no").cast("string"))), F.lit(4))
    dated = dated.withColumn("_at", F.pmod(_number(F.concat("key", F.lit("/"), F.col("change_no").cast("string"))), F.lit(_YEAR)))
    return dated.select(
        "key",
        "change_no",
        F.when(kind < 2, "block").when(kind == 2, "allow").otherwise("remove").alias("action"),
        _after_new_year("_at").alias("changed_at"),
    )


@_query(
    "op4_url_filters",
    rf"""
    with captures as (
      select page_id, url, timestamp '2024-01-01' + to_seconds((page_id * 104729) % {_YEAR}) as fetched_at,
        row_number() over () as id,
        nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') as host,
        nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)', 1), '') as segment
      from pages
    ), keys as (
      select id, 0 as rank, url as key from captures where url is not null
      union all select id, 1, host || '/' || segment from captures where host is not null and segment is not null
      union all select id, 2, host from captures where host is not null
      union all
      select id, (2 + i)::integer, array_to_string(string_split(host, '.')[i + 1:], '.')
      from captures, unnest(range(1, greatest(len(string_split(host, '.')) - 1, 1))) as t(i) where host is not null
    ), listed as (
      select distinct key from keys where rank > 0 or ('0x' || substr(md5(key), 1, 8))::bigint % 4 = 0
    ), changes as (
      select key, n,
        case ('0x' || substr(md5(key || '#' || n), 1, 8))::bigint % 4
          when 0 then 'block' when 1 then 'block' when 2 then 'allow' else 'remove' end as action,
        timestamp '2024-01-01' + to_seconds(('0x' || substr(md5(key || '/' || n), 1, 8))::bigint % {_YEAR}) as changed_at
      from listed, unnest(range(0, 4)) as t(n)
    ), last_of_moment as (
      select * from changes qualify coalesce(lead(changed_at) over (partition by key order by changed_at, n) > changed_at, true)
    ), turns as (
      select * from last_of_moment
      qualify coalesce(lag(action) over (partition by key order by changed_at) <> action, true)
    ), spans as (
      select *, lead(changed_at) over (partition by key order by changed_at) as valid_to from turns
    ), active as (
      select k.id, k.rank, s.* from keys k join captures c using (id)
      join spans s on s.key = k.key and s.changed_at <= c.fetched_at and (s.valid_to is null or c.fetched_at < s.valid_to)
      where s.action <> 'remove'
    ), best as (
      select *, count(*) over (partition by id) as n_active from active
      qualify row_number() over (partition by id order by rank) = 1
    )
    select c.page_id, c.url, c.fetched_at, c.host, coalesce(b.action, 'unlisted') as verdict, b.key as rule,
      b.changed_at as listed_from, b.valid_to as listed_to, coalesce(b.n_active, 0) as n_active
    from captures c left join best b using (id)
    """,
)
def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_lists.judged(page_captures(pages), page_list_changes(pages))


@_query("op5_kd_shards")
def op5_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight leaves of a k-d tree over id, size, source and language; the law kept is ``bytes``."""
    docs = _table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    # the texts are read once; the tree is built and applied on what is known about them
    known = cut(
        docs.select(
            "doc_id",
            "source",
            "lang",
            kd_shards.byte_size(F.col("text")).alias("bytes"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            kd_shards.document_tie().alias("tie"),
        )
    )
    dimensions = {**kd_shards.document_dimensions(), "size": F.log2(F.col("bytes").cast("double"))}
    placed = kd_shards.sharded(known, 3, dimensions, F.col("bytes"), F.col("tie"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@_query(
    "op6_systematic_mix",
    r"""
    with docs as (
      select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size from documents
    ), sources as (
      select source, sum(size)::bigint as source_size from docs group by source
    ), weighed as (
      select *, source_size * 2.0::double as cap, ([5.0, 2.0, 1.0]::double[])[
        (row_number() over (order by source nulls last) - 1) % 3 + 1] as weight
      from sources
    ), levels as (
      select *,
        ((sum(source_size) over ())::double * 1.5::double - coalesce(sum(cap) over (order by cap / weight, source nulls last
          rows between unbounded preceding and 1 preceding), 0::double))
        / sum(weight) over (order by cap / weight, source nulls last rows between current row and unbounded following) as level
      from weighed
    ), targets as (
      select source, source_size,
        least(cap, weight * (max(level) over ())) as target
      from levels
    ), placed as (
      select d.doc_id, d.size, t.source_size, t.target,
        row_number() over (partition by d.source order by d.size, d.doc_id nulls first) as place,
        case when t.source_size > 0 then t.target / t.source_size else 1.0::double end as each_one,
        ('0x' || substr(md5('mix:' || coalesce(d.source, '')), 1, 8))::bigint / 4294967296.0::double as first
      from docs d join targets t on d.source is not distinct from t.source
    )
    select doc_id, size, source_size, target,
      ((floor(place * each_one + first) - floor((place - 1) * each_one + first))::bigint * size)::bigint as taken
    from placed
    """,
)
def op6_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    counted = cut(docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("words")))
    taken = mixing.with_copies(counted, F.col("words"))
    return taken.select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_copies") * F.col("_size")).cast("bigint").alias("taken"),
    )


@_query("op7_arrow_tokens")
def op7_arrow_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return token_files.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"))


@_query("op8_certified_rules")
def op8_certified_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    ruled = quality_rules.judged(docs, _table(spark, sf_dir, "labels"))
    return ruled.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_rules", "certified_on"
    )


@_query("op9_section_tokens")
def op9_section_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return token_counts.section_tokens(_table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)


@_query("op10_simhash_components")
def op10_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fingerprint")).alias("fingerprint"), "component_id")


@_query("op11_recurrent_scores")
def op11_recurrent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores.scored(_table(spark, sf_dir, "documents"))


def _bit_planes_sql(clusters: int = 8, rounds: int = 10) -> str:
    """Rounds of assigning and averaging, one after the other, over one row per vector and component."""
    nearest = """
      select v.row, c.cluster, sum((v.x - c.x) * (v.x - c.x))::bigint as distance
      from parts v join {centroids} c using (k) group by v.row, c.cluster
      qualify row_number() over (partition by v.row order by distance, c.cluster) = 1"""
    steps = []
    for i in range(rounds):
        near = nearest.format(centroids=f"c{i}")
        steps.append(f"""
    n{i} as materialized ({near}
    ), c{i + 1} as materialized (
      select c.cluster, c.k, coalesce(m.x, c.x) as x
      from c{i} c left join (
        select n.cluster, v.k, (sum(v.x) // count(*) - (sum(v.x) % count(*) < 0)::integer)::bigint as x
        from n{i} n join parts v using (row) group by n.cluster, v.k
      ) m using (cluster, k)
    )""")
    last = nearest.format(centroids=f"c{rounds}")
    return f"""
    with vectors as materialized (
      select row_number() over () as row, vec_id, embedding::double[] as e from embeddings
      where len(embedding) = 64 and len([x for x in embedding if x is not null and isfinite(x)]) = 64
    ), parts as materialized (
      select row, k, floor(e[k] * 1024)::bigint as x from vectors, unnest(range(1, 65)) as t(k)
    ), c0 as materialized (
      select f.cluster, p.k, p.x from parts p join (
        select row, row_number() over (order by sha256('3:' || vec_id)) - 1 as cluster from vectors
        qualify cluster < {clusters}
      ) f using (row)
    ), {",".join(steps)},
    final as materialized ({last}
    ), named as (
      select cluster, sha256(string_agg(x::varchar, ',' order by k)) as centroid_sha256 from c{rounds} group by cluster
    )
    select v.vec_id, f.cluster::integer as cluster, f.distance,
      sum(f.distance) over (partition by f.cluster)::bigint as cluster_inertia,
      sum(f.distance) over ()::bigint as inertia, centroid_sha256
    from final f join vectors v using (row) join named using (cluster)
    """


@_query("op12_bit_plane_clusters", _bit_planes_sql())
def op12_bit_plane_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_planes.clustered(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@_query("op13_spelling_variants")
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))
