"""Answers of the three sources to landed batch documents.

An answer has ``app_id``, ``ingested_at`` (timestamp) and ``response``; it is taken apart, validated
against its source's contract, filled up with the contract's defaults and stamped. An answer that the
source refused, or that breaks the contract, is landed as failed: its payload is the answer as it
came, fields and text, or the message if there was none.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierkeep.operators import contracts as c
from tierkeep.operators.envelope import batched, code_succeeded, run_errors, run_statistics, stamped, unwrapped
from tierkeep.plans.silver import landing_path
from tierkeep.session import cut
from tierkeep.sources.batches import write_batches
from tierkeep.sources.schemas import DEFAULT_NAMES, PLAYERS_DDL, STATUS_SUCCESS, PayloadNames, reviews_ddl, store_ddl, struct_of


@dataclass(frozen=True)
class Landed:
    """What a run landed: one row of statistics, and its failed records."""

    statistics: DataFrame
    errors: DataFrame


def store_records(answers: DataFrame, names: PayloadNames = DEFAULT_NAMES) -> DataFrame:
    """Store answers, text ``{"<app_id>": {"success", "data"}}``, in batches (``_batch``) as records."""
    rows = unwrapped(answers, F.col("response"), F.col("app_id"), store_ddl(names))
    item = F.col("_data")
    refused = F.concat(F.lit("store answered success=false for "), F.col("app_id").cast("string"))
    endpoint = F.concat(F.lit("items/"), F.col("app_id").cast("string"))
    rules = c.store_rules(item, names)
    return _records(rows, rules, c.with_store_defaults(item), refused, "store_api", endpoint)


def review_records(answers: DataFrame, names: PayloadNames = DEFAULT_NAMES) -> DataFrame:
    """Review answers (text or struct with ``success`` and ``query_summary``) as records."""
    rows = _parsed(answers, reviews_ddl(names), F.col("_data.success"))
    answer = F.col("_data")
    rules = c.summary_rules(answer["query_summary"])
    filled = answer.withField("query_summary", c.with_summary_defaults(answer["query_summary"]))
    return _records(rows, rules, filled, F.lit("reviews answered success=0"), "reviews_api", F.lit("reviews"))


def player_records(answers: DataFrame) -> DataFrame:
    """Player answers (text or struct with ``player_count`` and ``result``) as records."""
    rows = _parsed(answers, PLAYERS_DDL, F.col("_data.result"))
    rules = c.player_rules(F.col("_data"))
    return _records(rows, rules, F.col("_data"), F.lit("players answered another result"), "player_stats_api", F.lit("players"))


def _parsed(answers: DataFrame, ddl: str, code: Column) -> DataFrame:
    """``_ok`` and ``_data``; a struct that lacks declared fields gets them as NULL."""
    kind = struct_of(ddl)
    answer = F.col("response")
    if answers.schema["response"].dataType.typeName() != "string":
        # through text, so that fields are found by name
        answer = F.to_json(answer)
    parsed = F.explode_outer(F.array(F.from_json(answer, kind)))
    return answers.select("*", parsed.alias("_data")).withColumn("_ok", code_succeeded(code))


def _records(rows: DataFrame, rules: list, filled: Column, refused: Column, source: str, endpoint: Column) -> DataFrame:
    rows = c.checked(rows, rules, "_broken")
    clean, message = c.validated(F.col("_ok"), F.col("_broken"), refused)
    made = stamped(
        rows.withColumns({"_clean": clean, "_message": F.when(~clean, message)}),
        key="app_id",
        batch=F.col("_batch"),
        source=F.lit(source),
        endpoint=endpoint,
        ingested_at=F.col("ingested_at"),
        succeeded=F.col("_clean"),
        error=F.col("_message"),
        response_ms=F.col("response_ms") if "response_ms" in rows.columns else None,
    )
    payload = F.when(F.col("_clean"), filled).otherwise(F.col("_data"))
    names = [f.name for f in made.select(payload.alias("p")).schema["p"].dataType if f.name not in ("error", RAW)]
    answer = F.col("response")
    if rows.schema["response"].dataType.typeName() != "string":
        answer = F.to_json(answer)
    raw = F.struct(
        *[payload[n].alias(n) for n in names], F.when(~F.col("_clean"), answer).alias(RAW), F.col("_message").alias("error")
    )
    inner = ("response", "response_ms", "_ok", "_data", "_broken", "_clean", "_message", "_batch")
    return made.withColumn("raw_data", raw).drop(*inner)


#: Field of a failed answer's payload with its text.
RAW = "raw_response"

RECORDS = {"store": store_records, "reviews": review_records, "player_stats": player_records}


def land(
    spark: SparkSession, answers: DataFrame, kind: str, bronze_root: str, run: str, size: int = 100, landing: str | None = None
) -> Landed:
    """Put answers into batches of at most ``size`` within each value of ``run``, and land them.

    Every call has batch ids of its own, with ``landing`` in them (a new random name by default). To
    land the same answers again after a failure, pass the same ``landing``: their batches are then known.
    The records are kept once, so that documents, statistics and errors tell of the same rows.
    """
    records = cut(RECORDS[kind](batched(answers, [F.col("app_id"), F.col("ingested_at")], run, size, landing or uuid.uuid4().hex)))
    write_batches(records, landing_path(bronze_root, kind))
    done = F.col("metadata.status") == STATUS_SUCCESS
    return Landed(run_statistics(records, records, 1, done), run_errors(records))
