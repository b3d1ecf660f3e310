"""Landed batch documents: one JSON document per batch with a ``records`` array."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierkeep.operators.envelope import batch_statistics
from tierkeep.session import cut, scratch
from tierkeep.sources.schemas import METADATA_DDL, STATUS_SUCCESS, batch_schema, struct_of


#: Holds the text of a document, or of a line of one, that could not be read.
UNREADABLE = "_unreadable"

#: Holds the file that a document was read from.
FILE = "_file"

#: Records that a batch document may hold.
MOST_RECORDS = 10_000


def read_documents(
    spark: SparkSession, path: str, payload_ddl: str, multi_line: bool | None = None, since: str | None = None
) -> DataFrame:
    """All batch documents below ``path`` (``date=YYYY-MM-DD`` folders), readable or not.

    One folder may hold files with a document per line, as ``write_batches`` writes them, which split
    over tasks, and files with one document spread over lines: ``spread_files`` tells them apart. With
    ``multi_line`` true or false all files are taken for one form and none is looked at beforehand.
    ``since`` reads only folders from that day on.
    """
    if multi_line is not None:
        return _wanted(_read_form(spark, path, path, payload_ddl, multi_line), since)
    spread = spread_files(spark, path, payload_ddl, since)
    lines = _wanted(_read_form(spark, path, path, payload_ddl, False), since)
    if not spread:
        return lines
    named = spark.createDataFrame([(name,) for name in spread], "_spread string")
    lines = lines.join(named, F.col(FILE) == F.col("_spread"), "left_anti")
    return lines.unionByName(_read_form(spark, spread, path, payload_ddl, True))


def _read_form(
    spark: SparkSession, files: str | list[str], base: str, payload_ddl: str, multi_line: bool
) -> DataFrame:
    return (
        spark.read.schema(document_schema(payload_ddl))
        .option("columnNameOfCorruptRecord", UNREADABLE)
        .option("multiLine", str(multi_line).lower())
        .option("basePath", base)
        .json(files)
        .select("*", F.col("_metadata.file_path").alias(FILE))
    )


def _wanted(documents: DataFrame, since: str | None) -> DataFrame:
    return documents if since is None else documents.filter(F.col("date").cast("string") >= F.lit(since))


def spread_files(spark: SparkSession, path: str, payload_ddl: str, since: str | None = None) -> list[str]:
    """The files below ``path`` that hold one document spread over lines, sorted.

    A file is asked about only if one of its lines neither is empty nor begins with { and ends with },
    which is seen without parsing. It is of the line form all the same if a line of it is a document
    with records, or if the file as a whole is JSON without a list of records: then its lines tell
    more. A broken file without any whole line counts as spread, so that it comes out once, not line
    by line. Only names reach the driver, which lists the files anyway.
    """
    line = F.trim(F.regexp_replace("value", r"[\r\uFEFF]", ""))
    texts = _wanted(spark.read.option("basePath", path).text(path).select("*", F.col("_metadata.file_path").alias(FILE)), since)
    doubtful = texts.filter((line != "") & ~(line.startswith("{") & line.endswith("}")))
    names = sorted(r[0] for r in doubtful.select(FILE).distinct().collect())
    if not names:
        return []
    by_line = _read_form(spark, names, path, payload_ddl, False).filter("records is not null").select(FILE).distinct()
    whole = _read_form(spark, names, path, payload_ddl, True).filter(f"records is not null or {UNREADABLE} is not null")
    return sorted(r[0] for r in whole.select(FILE).distinct().join(by_line, FILE, "left_anti").collect())


def document_schema(payload_ddl: str) -> StructType:
    return batch_schema(payload_ddl).add(UNREADABLE, "string")


def landed_rows(documents: DataFrame) -> DataFrame:
    """One row per record (metadata columns and ``raw_data``), and one per document without readable records.

    The latter have NULL in all columns but ``_unreadable``, which is empty for a document that is
    fine JSON but holds no list of records. A batch of no records gives no row. The file is passed on.
    """
    known = documents.filter("records is null or size(records) > 0")
    text = F.coalesce(F.col(UNREADABLE), F.lit(""))
    file = [c for c in (FILE,) if c in documents.columns]
    rows = known.select(F.when(F.col("records").isNull(), text).alias(UNREADABLE), *file, F.expr("inline_outer(records)"))
    return rows.select("metadata.*", "raw_data", UNREADABLE, *file)


def read_batches(
    spark: SparkSession,
    path: str,
    payload_ddl: str,
    multi_line: bool | None = None,
    since: str | None = None,
) -> DataFrame:
    """Records of all readable batch documents; see ``read_documents`` and ``landed_rows`` for the others.

    Metadata fields come out as columns, the payload as the struct ``raw_data``.
    """
    return flatten_batches(read_documents(spark, path, payload_ddl, multi_line, since))


def flatten_batches(documents: DataFrame) -> DataFrame:
    return documents.selectExpr("inline(records)").select("metadata.*", "raw_data")


def batch_documents(records: DataFrame, *by: str) -> DataFrame:
    """One row per batch out of rows with ``metadata`` and ``raw_data``; columns ``by`` are the same in a whole batch.

    Gathering is safe because ``batched`` bounds every batch, and ``write_batches`` checks it.
    """
    head = records.select("metadata", "raw_data", *by).withColumns(
        {"batch_id": F.col("metadata.batch_id"), "source": F.col("metadata.source")}
    )
    done = F.col("metadata.status") == STATUS_SUCCESS
    requested, succeeded = F.count("*"), F.count_if(done)
    statistics = F.struct(
        requested.alias("total_requested"),
        succeeded.alias("total_success"),
        (requested - succeeded).alias("total_failed"),
        (succeeded / requested * 100).alias("success_rate"),
    )
    documents = head.groupBy(*by, "batch_id", "source").agg(
        F.min("metadata.ingested_at").alias("started_at"),
        F.max("metadata.ingested_at").alias("completed_at"),
        statistics.alias("statistics"),
        F.collect_list(F.struct("metadata", "raw_data")).alias("records"),
    )
    return documents.drop(*by)


#: Records of one day that a task of ``write_batches`` should get.
TASK_RECORDS = 50_000


def write_batches(records: DataFrame, path: str, limit: int = MOST_RECORDS, compression: str | None = None) -> None:
    """Append batch documents under ``date=YYYY-MM-DD``, the day the batch started.

    Nothing is written, and ValueError raised, if a batch has more than ``limit`` records: a document
    is gathered in one task. The records are read twice, so pass written ones.

    Batches are sized and dated first, from their metadata alone, so that records move once, to the
    task that writes their day, and a large day is dealt out over several. ``compression`` (``gzip``)
    makes files many times smaller that a task then reads as a whole.
    """
    with scratch(records.sparkSession):
        named = F.xxhash64("metadata.source", "metadata.batch_id")
        found = records.groupBy("metadata.source", "metadata.batch_id").agg(
            F.count("*").alias("count"), F.substring(F.min("metadata.ingested_at"), 1, 10).alias("_day")
        )
        found = cut(found)
        large = found.filter(F.col("count") > limit).first()
        if large is not None:
            raise ValueError(f"batch {large['batch_id']} of {large['source']} has {large['count']} records, more than {limit}")
        tasks = F.ceil(F.sum("count").over(Window.partitionBy("_day")) / TASK_RECORDS)
        batch = F.xxhash64("source", "batch_id")
        # where a batch goes, by a hash of its name: two of one hash only go the same way
        tasked = found.select(batch.alias("_name"), F.hash("_day", F.pmod(batch, tasks)).alias("_task"))
        tasked = cut(tasked.groupBy("_name").agg(F.min("_task").alias("_task")))
        dealt = records.select("metadata", "raw_data", named.alias("_name")).join(tasked, "_name").drop("_name")
        documents = batch_documents(dealt.repartition("_task"), "_task").withColumn("date", F.substring("started_at", 1, 10))
        writer = documents.write.mode("append").partitionBy("date")
        (writer if compression is None else writer.option("compression", compression)).json(path)


def documents_statistics(spark: SparkSession, path: str, payload_ddl: str) -> DataFrame:
    """Batch statistics recounted from landed records."""
    return batch_statistics(read_batches(spark, path, payload_ddl), ["source", "batch_id"], F.col("status") == STATUS_SUCCESS)


def record_schema(payload_ddl: str) -> StructType:
    return struct_of(f"{METADATA_DDL}, raw_data {struct_of(payload_ddl).simpleString()}")
