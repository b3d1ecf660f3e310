"""Bronze queries: payloads built from the tables, landed as batch documents and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierkeep.functions.texts import joined, pick
from tierkeep.operators import contracts as c
from tierkeep.operators.envelope import (
    batched,
    run_errors,
    run_statistics,
    stamped,
    stored_payload,
    unwrapped,
)
from tierkeep.operators.latest import latest_per_key
from tierkeep.plans import bronze
from tierkeep.plans.silver import player_rows, review_rows, run_silver, store_rows
from tierkeep.queries.bindings import percent
from tierkeep.queries.registry import Query, query, table
from tierkeep.session import cut, scratch, scratch_path
from tierkeep.sources import registry, tables
from tierkeep.sources.batches import documents_statistics, read_batches, write_batches
from tierkeep.sources.schemas import PLAYERS_DDL, REVIEWS_CORE_DDL, reviews_ddl, store_core_ddl, store_ddl, struct_of


def store_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One store request per part and ship year, with the part's last line of that year."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus",
        F.year("l_shipdate").alias("run"), percent("l_discount").alias("pct"),
    )
    newest = [F.desc("l_shipdate"), F.desc("l_orderkey"), F.desc("l_linenumber")]
    seen = latest_per_key(lines, ["l_partkey", "run"], newest)
    parts = table(spark, sf_dir, "part")
    return seen.join(parts, F.col("l_partkey") == F.col("p_partkey")).withColumn("app_id", F.col("p_partkey"))


def answered(requests: DataFrame) -> DataFrame:
    """Requests with the store's response text.

    Returned lines answer with success false; lines numbered 7 answer for no key at all.
    """
    cents = F.round(F.col("p_retailprice") * 100).cast("int")
    paid = F.col("p_type") != "PROMO"
    rows = requests.withColumns({"cents": cents, "ingested_at": F.col("l_shipdate").cast("timestamp")})
    item = F.struct(
        F.lit("game").alias("type"),
        F.col("p_name").alias("name"),
        F.col("p_partkey").cast("int").alias("item_id"),
        F.col("p_size").cast("string").alias("required_age"),
        (~paid).alias("is_free"),
        F.concat_ws(" ", "p_brand", "p_type").alias("short_description"),
        F.array("p_brand").alias("developers"),
        F.array("p_brand", "p_type").alias("publishers"),
        F.when(
            paid,
            F.struct(
                F.lit("USD").alias("currency"),
                F.col("cents").alias("initial"),
                F.floor(F.col("cents") * (100 - F.col("pct")) / 100).cast("int").alias("final"),
                F.col("pct").alias("discount_percent"),
            ),
        ).alias("price_overview"),
        F.struct(
            (F.col("p_size") % 2 == 0).alias("windows"),
            (F.col("p_size") % 3 == 0).alias("mac"),
            (F.col("p_size") % 5 == 0).alias("linux"),
        ).alias("platforms"),
        F.when(F.col("p_size") > 12, F.struct((F.col("p_size") * 2).alias("score"))).alias("metacritic"),
        F.array(F.struct(F.col("p_size").alias("id"), F.col("p_type").alias("description"))).alias("categories"),
        F.transform(
            F.split("p_name", " "), lambda word, place: F.struct(place.cast("string").alias("id"), word.alias("description"))
        ).alias("genres"),
        F.struct(
            (F.col("l_linestatus") == "O").alias("coming_soon"), F.date_format("l_shipdate", "MMM d, yyyy").alias("date")
        ).alias("release_date"),
    )
    good = F.to_json(F.create_map(F.col("p_partkey").cast("string"), F.struct(F.lit(True).alias("success"), item.alias("data"))))
    bad = F.to_json(F.create_map(F.col("p_partkey").cast("string"), F.struct(F.lit(False).alias("success"))))
    response = F.when(F.col("l_linenumber") == 7, F.lit("{}")).when(F.col("l_returnflag") == "R", bad).otherwise(good)
    kept = [c for c in ("app_id", "run", "ingested_at", "_batch") if c in rows.columns]
    return rows.select(*kept, response.alias("response"))


def store_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answered(store_requests(spark, sf_dir))


STORE_SQL = """
so as (select *, year(l_shipdate) run, row_number() over (partition by l_partkey, year(l_shipdate)
          order by l_shipdate desc, l_orderkey desc, l_linenumber desc) rn from lineitem),
st as (select p.*, run, l_shipdate shipped, l_linestatus = 'O' coming_soon, l_linenumber <> 7 and l_returnflag <> 'R' ok,
              p_type = 'PROMO' is_free, cast(round(p_retailprice * 100) as int) cents, cast(round(l_discount * 100) as int) pct,
              case when p_size > 12 then p_size * 2 end score,
              concat(run, '-', cast((row_number() over (order by run, l_partkey) - 1) // 100 as varchar)) batch
       from so join part p on p_partkey = l_partkey where rn = 1)"""


def store_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests put into batches of up to 100 per year; responses unwrapped, validated and stamped."""
    rows = answered(batched(store_requests(spark, sf_dir), [F.col("app_id")], "run"))
    return bronze.store_records(rows.withColumn("response_ms", F.lit(1.5))).select("app_id", "run", "metadata", "raw_data")


@query(
    "keyed_map",
    f"""with {STORE_SQL}
select p_partkey app_id, run, ok succeeded, case when ok then p_name end "name",
       case when ok and not is_free then cents * (100 - pct) // 100 end final_cents from st""",
)
def keyed_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``{"<key>": {"success", "data"}}`` responses taken apart; absent keys count as failed."""
    rows = unwrapped(store_responses(spark, sf_dir), F.col("response"), F.col("app_id"), store_ddl())
    return rows.select(
        "app_id",
        F.col("run").cast("bigint").alias("run"),
        F.col("_ok").alias("succeeded"),
        F.col("_data.name").alias("name"),
        F.col("_data.price_overview.final").alias("final_cents"),
    )


@query(
    "raw_payload",
    f"""with {STORE_SQL}
select p_partkey app_id, run, case when ok then p_name end "name",
       case when not ok then 'refused ' || p_partkey end error from st""",
)
def raw_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is kept of each response: the data of a success, the message of a failure."""
    rows = unwrapped(store_responses(spark, sf_dir), F.col("response"), F.col("app_id"), store_ddl())
    message = F.concat(F.lit("refused "), F.col("app_id").cast("string"))
    kept = rows.withColumn("kept", stored_payload(F.col("_ok"), F.col("_data"), F.col("response"), message, keep_raw=False))
    field = F.from_json("kept", "name string, error string")
    return kept.select(
        "app_id", F.col("run").cast("bigint").alias("run"), field["name"].alias("name"), field["error"].alias("error")
    )


def _landed(spark: SparkSession, sf_dir: str, records: Query, label: str) -> str:
    """The folder of the landed ``records``; what was kept to make them is deleted as soon as they are written."""
    path = scratch_path(spark, label)
    with scratch(spark):
        with scratch(spark) as keep:
            made = keep(cut(records(spark, sf_dir)))
        write_batches(made, path, compression="gzip")
    return path


@query(
    "envelope",
    f"""with {STORE_SQL}
select md5(concat(batch, '/store_api/', p_partkey)) record_id, batch batch_id, cast(p_partkey as int) app_id,
       case when ok then 'success' else 'failed' end status,
       case when not ok then 'store answered success=false for ' || p_partkey end error_message,
       'items/' || p_partkey source_endpoint, strftime(shipped, '%Y-%m-%d') "day", 1.5::double api_response_time_ms
from st""",
)
def envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written as batch documents and read back with the declared schema."""
    path = _landed(spark, sf_dir, store_records, "store")
    return read_batches(spark, path, store_core_ddl()).select(
        "record_id",
        "batch_id",
        F.col("request_params.app_id").alias("app_id"),
        "status",
        "error_message",
        "source_endpoint",
        F.substring("ingested_at", 1, 10).alias("day"),
        "api_response_time_ms",
    )


@query(
    "landed_batch_stats",
    f"""with {STORE_SQL}
select 'store_api' source, batch batch_id, count(*) total_requested, count(*) filter (where ok) total_success,
       count(*) filter (where not ok) total_failed, count(*) filter (where ok) / cast(count(*) as double) * 100 success_rate
from st group by batch""",
)
def landed_batch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _landed(spark, sf_dir, store_records, "store")
    return documents_statistics(spark, path, store_core_ddl())


@query(
    "run_stats",
    f"""with {STORE_SQL}
select count(*) operations, count(*) filter (where ok) successful, count(*) filter (where not ok) failed,
       count(*) filter (where ok) / cast(count(*) as double) * 100 success_rate,
       case when count(*) filter (where ok) / cast(count(*) as double) * 100 >= 80 then 'success' else 'partial' end status
from st""",
)
def run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = store_records(spark, sf_dir)
    requested = store_responses(spark, sf_dir).select("app_id", "run")
    return run_statistics(records, requested, 1, F.col("metadata.status") == "success")


@query(
    "run_errors",
    f"""with {STORE_SQL}
select 'store_api' source, cast(p_partkey as int) app_id, 'store answered success=false for ' || p_partkey error
from st where not ok""",
)
def failed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_errors(store_records(spark, sf_dir))


@query(
    "typed_store",
    f"""with {STORE_SQL},
latest as (select *, row_number() over (partition by p_partkey order by shipped desc, batch desc) n from st where ok)
select cast(p_partkey as int) app_id, p_name "name", 'game' "type", is_free, p_brand || ' ' || p_type short_description,
       p_brand developers, p_brand || ', ' || p_type publishers,
       case when not is_free then 'USD' end price_currency, case when not is_free then cents end price_initial_cents,
       case when not is_free then cents * (100 - pct) // 100 end price_final_cents,
       case when not is_free then pct end price_discount_percent,
       p_size % 2 = 0 platforms_windows, p_size % 3 = 0 platforms_mac, p_size % 5 = 0 platforms_linux,
       score metacritic_score, p_type categories, replace(p_name, ' ', ', ') genres,
       strftime(shipped, '%b %-d, %Y') release_date, coming_soon, batch _source_batch_id,
       strftime(shipped, '%Y-%m-%d') _ingested_at from latest where n = 1""",
)
def typed_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All item attributes of the latest successful record per item, from landed documents."""
    path = _landed(spark, sf_dir, store_records, "store")
    rows = store_rows(read_batches(spark, path, store_core_ddl()))
    arrays = {a: joined(F.col(a)) for a in ("developers", "publishers", "categories", "genres")}
    return rows.withColumns({**arrays, "_ingested_at": F.date_format("_ingested_at", "yyyy-MM-dd")})


def review_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review response per user and day: purchases are positive, errors negative.

    Days without either answer with success 0.
    """
    days = table(spark, sf_dir, "events").groupBy(
        F.col("user_id").alias("app_id"), F.date_format("ts", "yyyy-MM-dd").alias("run")
    ).agg(
        F.count_if(F.col("event_type") == "purchase").cast("int").alias("positive"),
        F.count_if(F.col("event_type") == "error").cast("int").alias("negative"),
    )
    total = F.col("positive") + F.col("negative")
    payload = F.struct(
        F.when(total > 0, 1).otherwise(0).alias("success"),
        F.struct(
            F.lit(0).alias("num_reviews"),
            (total % 10).alias("review_score"),
            F.when(F.col("positive") > F.col("negative"), "Positive").otherwise("Mixed").alias("review_score_desc"),
            F.col("positive").alias("total_positive"),
            F.col("negative").alias("total_negative"),
            total.alias("total_reviews"),
        ).alias("query_summary"),
    )
    rows = days.withColumns({"response": payload, "ingested_at": F.col("run").cast("timestamp")})
    made = bronze.review_records(batched(rows, [F.col("app_id")], "run"))
    return made.select("app_id", "run", "metadata", "raw_data")


REVIEWS_SQL = """
re as (select user_id, strftime(ts, '%Y-%m-%d') run, count(*) filter (where event_type = 'purchase') pos,
              count(*) filter (where event_type = 'error') neg from events group by 1, 2)"""


@query(
    "typed_reviews",
    f"""with {REVIEWS_SQL},
latest as (select *, row_number() over (partition by user_id order by run desc) n from re where pos + neg > 0)
select cast(user_id as int) app_id, cast(pos + neg as int) total_reviews, cast(pos as int) total_positive,
       cast(neg as int) total_negative, cast((pos + neg) % 10 as int) review_score,
       case when pos > neg then 'Positive' else 'Mixed' end review_score_desc,
       pos / cast(pos + neg as double) positive_ratio, run _ingested_at from latest where n = 1""",
)
def typed_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _landed(spark, sf_dir, review_records, "reviews")
    rows = review_rows(read_batches(spark, path, REVIEWS_CORE_DDL)).drop("_source_batch_id")
    return rows.withColumn("_ingested_at", F.date_format("_ingested_at", "yyyy-MM-dd"))


def player_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One player count per user and day: the day's events. Days of sign-ups only fail."""
    days = table(spark, sf_dir, "events").groupBy(
        F.col("user_id").alias("app_id"), F.date_format("ts", "yyyy-MM-dd").alias("run")
    ).agg(F.count("*").cast("int").alias("n"), F.count_if(F.col("event_type") == "signup").alias("signups"))
    payload = F.struct(
        F.col("n").alias("player_count"), F.when(F.col("n") > F.col("signups"), 1).otherwise(42).alias("result")
    )
    rows = days.withColumns({"response": payload, "ingested_at": F.col("run").cast("timestamp")})
    made = bronze.player_records(batched(rows, [F.col("app_id")], "run"))
    return made.select("app_id", "run", "metadata", "raw_data")


def player_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The answers behind ``player_records`` as JSON text."""
    records = player_records(spark, sf_dir)
    answer = F.to_json(F.struct("raw_data.player_count", "raw_data.result"))
    return records.select("app_id", "run", F.col("run").cast("timestamp").alias("ingested_at"), answer.alias("response"))


PLAYERS_SQL = """
pl as (select user_id, strftime(ts, '%Y-%m-%d') run, count(*) n, count(*) filter (where event_type = 'signup') signups
       from events group by 1, 2)"""


@query(
    "typed_players",
    f"""with {PLAYERS_SQL}
select cast(user_id as int) app_id, cast(n as int) player_count, run snapshot_date from pl where n > signups""",
)
def typed_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _landed(spark, sf_dir, player_records, "players")
    return player_rows(read_batches(spark, path, PLAYERS_DDL)).select("app_id", "player_count", "snapshot_date")


@query(
    "landed_failures",
    f"""with {PLAYERS_SQL}, {REVIEWS_SQL}
select 'player_stats' kind, user_id app_id, run, n answered, cast(42 as bigint) code,
       '{{"player_count":' || n || ',"result":42}}' raw_response, 'players answered another result' error
from pl where n = signups
union all
select 'reviews', user_id, run, pos + neg, 0, null, 'reviews answered success=0' from re where pos + neg = 0""",
)
def landed_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers that were refused, read back as landed: what was answered is kept, as fields and as text."""
    players = read_batches(spark, _landed(spark, sf_dir, player_records, "players"), PLAYERS_DDL)
    reviews = read_batches(spark, _landed(spark, sf_dir, review_records, "reviews"), reviews_ddl())
    raw = F.col("raw_data")
    parts = (
        ("player_stats", players, raw["player_count"], raw["result"], raw["raw_response"]),
        # the text of these has all fields of the summary; it is compared with them in the tests
        ("reviews", reviews, raw["query_summary"]["total_reviews"], raw["success"], F.lit(None).cast("string")),
    )
    frames = [
        rows.filter("status = 'failed'").select(
            F.lit(kind).alias("kind"),
            F.col("request_params.app_id").cast("bigint").alias("app_id"),
            F.substring("ingested_at", 1, 10).alias("run"),
            answered.cast("bigint").alias("answered"),
            code.cast("bigint").alias("code"),
            text.alias("raw_response"),
            F.col("error_message").alias("error"),
        )
        for kind, rows, answered, code, text in parts
    ]
    return frames[0].unionByName(frames[1])


@query(
    "players_landed_twice",
    f"""with {PLAYERS_SQL}
select cast(user_id as int) app_id, cast(n as int) player_count, run snapshot_date from pl where n > signups""",
)
def players_landed_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact after two landings of the same runs, for even and odd keys, and one landing repeated under its name."""
    answers, root = cut(player_answers(spark, sf_dir)), scratch_path(spark, "landings")
    for odd, name in ((0, "even"), (1, None), (0, "even")):
        bronze.land(spark, answers.filter(F.pmod("app_id", F.lit(2)) == odd), "player_stats", root, "run", landing=name)
        run_silver(spark, root, root, as_of="2024-02-01", include=("players",))
    fact = tables.read(spark, registry.PLAYER_FACT.path(root), registry.PLAYER_FACT.ddl)
    return fact.select("app_id", "player_count", "snapshot_date")


@query(
    "mixed_document_forms",
    f"""with {PLAYERS_SQL}
select cast(user_id as int) app_id, cast(n as int) player_count, run snapshot_date from pl where n > signups""",
)
def mixed_document_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts out of a folder where every tenth day's documents are files of their own, spread over lines."""
    landed = spark.read.text(_landed(spark, sf_dir, player_records, "players")).withColumn("date", F.col("date").cast("string"))
    mixed, own_file = scratch_path(spark, "mixed"), F.col("date").endswith("1")
    landed.filter(~own_file).write.partitionBy("date").text(mixed)
    spread = landed.filter(own_file).withColumn("value", F.regexp_replace("value", r'([\[,])(\{"metadata":|"records":)', "$1\n  $2"))
    spread.write.mode("append").partitionBy("date").option("maxRecordsPerFile", 1).text(mixed)
    return player_rows(read_batches(spark, mixed, PLAYERS_DDL)).select("app_id", "player_count", "snapshot_date")


@query(
    "success_codes",
    f"""with {PLAYERS_SQL}
select user_id app_id, run, case when n > signups then 'success' else 'failed' end status from pl""",
)
def success_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return player_records(spark, sf_dir).select("app_id", "run", F.col("metadata.status").alias("status"))


@query(
    "contract_violations",
    """select rule, count(*) n from (
         select 'discount_range' rule from lineitem where l_discount < 0.02 or l_discount > 0.08
         union all select 'quantity_min' from lineitem where l_quantity < 5) x group by rule""",
)
def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each rule is broken; a line may break several."""
    lines = table(spark, sf_dir, "lineitem")
    rules = [c.in_range("discount", F.col("l_discount"), (0.02, 0.08)), c.at_least("quantity", F.col("l_quantity"), 5)]
    broken = c.checked(lines, rules).select(F.explode("violations").alias("rule"))
    return broken.groupBy("rule").agg(F.count("*").alias("n"))


@query(
    "contract_routing",
    """select l_orderkey, l_linenumber, case when l_discount < 0.02 or l_discount > 0.08 then 'discount_range'
              when l_quantity < 5 then 'quantity_min' else 'valid' end route from lineitem""",
)
def contract_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line either valid or quarantined under its first broken rule."""
    lines = table(spark, sf_dir, "lineitem")
    rules = [c.in_range("discount", F.col("l_discount"), (0.02, 0.08)), c.at_least("quantity", F.col("l_quantity"), 5)]
    valid, quarantine = c.routed(c.checked(lines, rules))
    columns = ["l_orderkey", "l_linenumber"]
    return valid.select(*columns, F.lit("valid").alias("route")).unionByName(
        quarantine.select(*columns, F.col("violations")[0].alias("route"))
    )


@query(
    "store_contract",
    f"""with {STORE_SQL}
select p_partkey app_id, run, concat_ws(', ', case when p_partkey < 1 then 'app_id_min' end,
       case when ok and not is_free and (pct < 2 or pct > 8) then 'discount_range' end) broken,
       case when ok and p_size < 18 then p_size when ok then 18 end age,
       case when ok and not is_free then round(cents / 100.0, 2)::double end initial_dollars,
       case when ok then len(string_split(p_name, ' ')) end genre_count
from st""",
)
def store_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store payloads against the contract, with defaults and derived fields."""
    rows = unwrapped(store_responses(spark, sf_dir), F.col("response"), F.col("app_id"), store_ddl())
    rows = rows.withColumnRenamed("_data", "item")
    item = F.col("item")
    rules = [
        *c.key_rules(F.col("app_id")),
        *[rule for rule in c.store_rules(item) if not rule.name.endswith("required")],
        c.in_range("discount", item["price_overview"]["discount_percent"], (2, 8)),
    ]
    derived = c.store_derived(item)
    return c.checked(rows, rules).select(
        "app_id",
        F.col("run").cast("bigint").alias("run"),
        F.concat_ws(", ", "violations").alias("broken"),
        F.when(item.isNotNull(), F.least(c.with_store_defaults(item)["required_age"], F.lit(18))).alias("age"),
        derived["initial_dollars"].cast("double").alias("initial_dollars"),
        F.when(item.isNotNull(), F.size(derived["genre_names"])).cast("bigint").alias("genre_count"),
    )


@query(
    "review_rows",
    """select cast(source_id as int) app_id, cast(doc_id as varchar) review_id, lang "language", quality = 1 voted_up,
       n_chars / 60.0::double playtime_hours, strftime(to_timestamp(doc_id * 60), '%Y-%m-%d %H:%M') created,
       concat_ws(', ', case when quality is null then 'voted_up_required' end, case when toxic = 1 then 'votes_up_min' end) broken
from (select d.*, l.quality, l.toxic, cast(replace(source, 'src', '') as int) source_id from documents d left join labels l using (doc_id)) x""",
)
def single_review_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as reviews: taken out of review payloads, checked, with times and hours; labels are votes."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    shape = struct_of(reviews_ddl())["reviews"].dataType.elementType
    fields = {
        "recommendationid": F.col("doc_id").cast("string"),
        "author": F.struct(
            F.lit("a").alias("author_id"), *[
                (F.col("n_chars") if name == "playtime_at_review" else F.lit(0)).cast("int").alias(name) for name in c.AUTHOR_COUNTERS
            ], F.lit(0).cast("bigint").alias("last_played"),
        ),
        "language": F.col("lang"),
        "review": F.col("text"),
        "timestamp_created": F.col("doc_id") * 60,
        "timestamp_updated": F.col("doc_id") * 60,
        "voted_up": F.col("quality") == 1,
        "votes_up": -F.col("toxic"),
    }
    review = F.struct(*[fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in shape.fields])
    # one payload per review: a payload never gathers a whole source
    payload = docs.select(
        F.struct(F.regexp_replace("source", "src", "").cast("int").alias("app_id")).alias("request_params"),
        F.struct(F.array(review).alias("reviews")).alias("raw_data"),
    )
    row = F.col("review")
    return c.single_reviews(payload).select(
        "app_id",
        row["recommendationid"].alias("review_id"),
        row["language"].alias("language"),
        row["voted_up"].alias("voted_up"),
        "playtime_hours",
        F.date_format("created_at", "yyyy-MM-dd HH:mm").alias("created"),
        F.concat_ws(", ", "violations").alias("broken"),
    )


@query(
    "summary_contract",
    f"""with {REVIEWS_SQL}
select user_id app_id, run, pos / nullif(cast(pos + neg as double), 0) positive_ratio,
       (pos + neg) % 10 > 3 high_score from re""",
)
def summary_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review summaries with a score limit of 3 in place of 9, and the ratio (NULL without reviews)."""
    records = review_records(spark, sf_dir)
    summary = c.with_summary_defaults(F.col("raw_data.query_summary"))
    rows = records.select("app_id", "run", summary.alias("s"))
    rules = [*c.summary_rules(F.col("s")), c.in_range("high_score", F.col("s.review_score"), (0, 3))]
    return c.checked(rows, rules).select(
        "app_id", "run", c.summary_ratio(F.col("s")).alias("positive_ratio"),
        F.array_contains("violations", "high_score_range").alias("high_score"),
    )


@query(
    "player_contract",
    f"""with {PLAYERS_SQL}
select user_id app_id, run, n - 3 player_count, n - 3 < 0 rejected from pl""",
)
def player_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Player counts lowered by 3: negative ones are rejected."""
    records = player_records(spark, sf_dir)
    payload = F.struct((F.col("raw_data.player_count") - 3).alias("player_count"), F.col("raw_data.result").alias("result"))
    rows = records.select("app_id", "run", payload.alias("p"))
    tagged = c.checked(rows, c.player_rules(F.col("p")))
    return tagged.select(
        "app_id", "run", F.col("p.player_count").cast("bigint").alias("player_count"), (F.size("violations") > 0).alias("rejected")
    )
