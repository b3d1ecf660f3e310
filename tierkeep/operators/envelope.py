"""Shape landed payloads into records and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierkeep.functions.measures import count_where
from tierkeep.operators.keys import assign_chunks
from tierkeep.sources.schemas import PIPELINE_VERSION, STATUS_FAILED, STATUS_PARTIAL, STATUS_SUCCESS, struct_of

# Success codes inside payloads and the share of successes a good run needs.
SUCCESS_CODE = 1
GOOD_RUN_PERCENT = 80.0


def unwrap_keyed(payload: Column, key: Column, data_ddl: str) -> tuple[Column, Column]:
    """(succeeded, data) out of ``{"<key>": {"success": ..., "data": {...}}}`` text.

    An absent key or a false flag has not succeeded and has no data.
    """
    entry_type = f"map<string, struct<success: boolean, data: {struct_of(data_ddl).simpleString()}>>"
    entry = F.try_element_at(F.from_json(payload, entry_type), key.cast("string"))
    succeeded = F.coalesce(entry.getField("success"), F.lit(False))
    return succeeded, F.when(succeeded, entry.getField("data"))


def unwrapped(df: DataFrame, payload: Column, key: Column, data_ddl: str) -> DataFrame:
    """``df`` with ``_ok`` and ``_data`` of ``unwrap_keyed``; the text is parsed once, whatever uses them.

    The parsed entry comes out of a generator, which Spark does not copy into the expressions and
    filters above it.
    """
    entry_type = f"map<string, struct<success: boolean, data: {struct_of(data_ddl).simpleString()}>>"
    entry = F.try_element_at(F.from_json(payload, entry_type), key.cast("string"))
    rows = df.select("*", F.explode_outer(F.array(entry)).alias("_entry"))
    succeeded = F.coalesce(F.col("_entry.success"), F.lit(False))
    return rows.withColumns({"_ok": succeeded, "_data": F.when(succeeded, F.col("_entry.data"))}).drop("_entry")


def code_succeeded(code: Column) -> Column:
    return F.coalesce(code == SUCCESS_CODE, F.lit(False))


def status_text(succeeded: Column) -> Column:
    return F.when(succeeded, F.lit(STATUS_SUCCESS)).otherwise(F.lit(STATUS_FAILED))


def stored_payload(succeeded: Column, data: Column, raw: Column, error: Column, keep_raw: bool = True) -> Column:
    """JSON text to keep: the data, else the raw response, else the error message.

    With ``keep_raw`` false a failure always keeps the error message.
    """
    message = F.to_json(F.struct(error.alias("error")), {"ignoreNullFields": "false"})
    parsed = F.when(succeeded, F.to_json(data))
    return F.coalesce(parsed, raw, message) if keep_raw else F.coalesce(parsed, message)


def stamped(
    df: DataFrame,
    *,
    key: str,
    batch: Column,
    source: Column,
    endpoint: Column,
    ingested_at: Column,
    succeeded: Column,
    error: Column,
    response_ms: Column | None = None,
    environment: str = "development",
) -> DataFrame:
    """Add the ``metadata`` struct. Record ids are hashes of batch, source and key: a retry repeats them."""
    succeeded = F.coalesce(succeeded, F.lit(False))
    metadata = F.struct(
        F.md5(F.concat_ws("/", batch, source, F.col(key).cast("string"))).alias("record_id"),
        batch.cast("string").alias("batch_id"),
        source.alias("source"),
        endpoint.alias("source_endpoint"),
        F.date_format(ingested_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ingested_at"),
        (F.lit(None) if response_ms is None else response_ms).cast("double").alias("api_response_time_ms"),
        status_text(succeeded).alias("status"),
        F.when(~succeeded, error).cast("string").alias("error_message"),
        F.struct(F.col(key).cast("int").alias("app_id")).alias("request_params"),
        F.lit(environment).alias("environment"),
        F.lit(PIPELINE_VERSION).alias("pipeline_version"),
    )
    return df.withColumn("metadata", metadata)


def batched(df: DataFrame, order: list[Column], run: str, size: int = 100, landing: str | None = None) -> DataFrame:
    """Add ``_batch``: at most ``size`` consecutive rows of one run share an id.

    Runs are numbered through, so no run has to be gathered or joined to find its first row; a run
    may only begin and end with a smaller batch. Numbers begin at 0 in every call; ``landing``, put
    into the ids, tells the batches of one call from those of another.
    """
    chunked = assign_chunks(df, [F.col(run), *order], size, "_chunk")
    parts = [F.col(run).cast("string"), *([] if landing is None else [F.lit(landing)]), F.col("_chunk")]
    return chunked.withColumn("_batch", F.concat_ws("-", *parts)).drop("_chunk")


def batch_statistics(records: DataFrame, by: list[str], succeeded: Column) -> DataFrame:
    """Requested, succeeded, failed and success rate, counted from the records themselves."""
    return records.groupBy(*by).agg(
        F.count("*").alias("total_requested"),
        count_where(succeeded).alias("total_success"),
        (F.count("*") - count_where(succeeded)).alias("total_failed"),
        success_rate(count_where(succeeded), F.count("*")).alias("success_rate"),
    )


def success_rate(succeeded: Column, requested: Column) -> Column:
    """Percentage; NULL when nothing was requested."""
    return F.try_divide(succeeded.cast("double"), requested.cast("double")) * 100


def run_statistics(records: DataFrame, requested: DataFrame, sources: int, succeeded: Column) -> DataFrame:
    """One row for a run: operations are requested keys times sources; no operations is 100 %."""
    operations = requested.select((F.count("*") * sources).alias("operations")).scalar()
    counts = records.agg(
        count_where(succeeded).alias("successful"),
        (F.count("*") - count_where(succeeded)).alias("failed"),
    )
    rate = F.coalesce(success_rate(F.col("successful"), F.col("operations")), F.lit(100.0))
    verdict = F.when(F.col("success_rate") >= GOOD_RUN_PERCENT, STATUS_SUCCESS).otherwise(STATUS_PARTIAL)
    return counts.withColumn("operations", operations).withColumn("success_rate", rate).withColumn("status", verdict)


def run_errors(records: DataFrame) -> DataFrame:
    """Failed records of a run: source, key, message. Pass landed or kept records, not their making."""
    return records.filter(F.col("metadata.status") != STATUS_SUCCESS).select(
        F.col("metadata.source").alias("source"),
        F.col("metadata.request_params.app_id").alias("app_id"),
        F.col("metadata.error_message").alias("error"),
    )
