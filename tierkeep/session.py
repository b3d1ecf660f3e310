"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


class _Unnoted:
    """Takes notes and forgets them."""

    def append(self, note: object) -> None:
        pass


def local_session(app: str = "tierkeep", cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder; on a cluster a
    missing setting is an error, because a machine-local folder is lost with its machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tierkeep-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a table below the shared folder, so every later use sees the same rows.

    A written table survives lost executors, is compressed, lets later steps read only the columns
    they need, and has a known size by which Spark chooses its joins.
    """
    path = scratch_path(df.sparkSession, "kept")
    df.write.parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    _written.get().append((kept, path))
    return kept


#: Tables written by ``cut`` in the innermost open ``scratch``; outside any, nothing is noted.
_written: ContextVar[list[tuple[DataFrame, str]] | _Unnoted] = ContextVar("written", default=_Unnoted())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A block at whose end the tables that ``cut`` wrote inside are deleted.

    The function that it yields is given a table that is to outlast the block, as ``cut`` returned
    it, and returns it; the block around, if there is one, deletes it then. After an error nothing
    is deleted. Rows that are still to be read from a deleted table are lost, so results must be cut
    and kept, or be asked for inside.
    """
    outer, inner = _written.get(), []
    kept: list[DataFrame] = []

    def keep(table: DataFrame) -> DataFrame:
        kept.append(table)
        return table

    token = _written.set(inner)
    try:
        yield keep
    finally:
        _written.reset(token)
    for table, path in inner:
        if any(table is k for k in kept):
            outer.append((table, path))
        else:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
