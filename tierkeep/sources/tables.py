"""Read and write tables as columnar files.

Two layouts. Append tables are plain partitioned folders. Replaced tables get a new ``v=N`` folder
per write and readers take the newest finished one, so a job never overwrites what it reads and a
failed write is never seen. Dimensions keep the closed versions as one folder per merge, never
rewritten, and the current slice in buckets of the key's hash: a merge writes only the buckets in which
it changes a row, and a manifest per version tells which earlier version holds each of the others.

A writer claims its version's number by creating a file that must not be there yet, so two writers
never write the same folder. ``release`` deletes versions that no reader needs any more.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tierkeep.functions.times import AsOf
from tierkeep.operators.scd2 import Merged, parted
from tierkeep.sources.folders import by_folder
from tierkeep.sources.registry import CATALOG, ITEM_DIM, REVIEW_DIM, TableSpec, empty_table
from tierkeep.sources.schemas import struct_of

# Marker of a finished write, folder name of the NULL partition.
DONE = "_SUCCESS"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _folder(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _folder(spark, path)
    return fs.exists(where)


def finished_versions(spark: SparkSession, path: str, after: int = -1) -> list[int]:
    """The numbers of all finished ``v=N`` below the path that are higher than ``after``, ascending."""
    fs, where = _folder(spark, path)
    if not fs.exists(where):
        return []
    names = [entry.getPath().getName() for entry in fs.listStatus(where)]
    numbers = [int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit()]
    return sorted(n for n in numbers if n > after and exists(spark, f"{path}/v={n}/{DONE}"))


def newest_version(spark: SparkSession, path: str) -> int | None:
    """The highest finished ``v=N`` below the path, or None."""
    return max(finished_versions(spark, path), default=None)


def read(spark: SparkSession, path: str, ddl: str | None = None, merge_schema: bool = False, fmt: str = "parquet") -> DataFrame:
    """An append table. With a declared schema no footers are merged and absent columns are NULL."""
    reader = spark.read.format(fmt)
    if ddl is not None:
        declared = struct_of(ddl)
        return reader.schema(declared).load(path).select(*declared.names)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.load(path)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Add rows; columns may differ from those written before (see ``read``)."""
    by_folder(df, partition_by).write.format(fmt).mode("append").partitionBy(*partition_by).save(path)


class Conflict(RuntimeError):
    """Another writer has written, or is writing, the version that would follow."""


#: Seconds after which the claim of a writer that did not finish counts as left behind.
LEASE = 3600.0


def _claim_path(path: str, number: int) -> str:
    return f"{path}/_claims/{number}"


def claim(spark: SparkSession, path: str, number: int, lease: float = LEASE) -> bool:
    """Take a version's number for this writer; False if another has it, finished or not older than ``lease``."""
    if exists(spark, f"{path}/v={number}/{DONE}"):
        return False
    fs, where = _folder(spark, _claim_path(path, number))
    try:
        fs.create(where, False).close()
        return True
    except Py4JJavaError:
        if not fs.exists(where):
            raise
    if time.time() - fs.getFileStatus(where).getModificationTime() / 1000 <= lease:
        return False
    fs.create(where, True).close()
    return True


def _give_up(spark: SparkSession, path: str, number: int) -> None:
    fs, where = _folder(spark, _claim_path(path, number))
    fs.delete(where, False)


def replace(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet", version: int | None = None
) -> int:
    """Write the whole table as its next version, or as a given one; schema and content may change freely.

    The next version is the first that no other writer has claimed, so of writers at the same time
    each gets its own and the highest is read. A given version is the caller's, and written over.
    """
    spark, claimed = df.sparkSession, version is None
    if version is None:
        newest = newest_version(spark, path)
        version = 0 if newest is None else newest + 1
        while not claim(spark, path, version):
            version += 1
    try:
        # an unfinished attempt may have left files under this number
        df.write.format(fmt).mode("overwrite").partitionBy(*partition_by).save(f"{path}/v={version}")
    except Exception:
        if claimed:
            _give_up(spark, path, version)
        raise
    return version


def release(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Delete all finished versions of a replaced table but the newest ``keep``, and return their numbers.

    Readers that began before have the older of the kept ones. For a dimension's slice, whose versions
    share buckets, see ``release_slices``.
    """
    if keep < 1:
        raise ValueError("the newest version is always kept")
    gone = finished_versions(spark, path)[:-keep]
    for number in gone:
        fs, where = _folder(spark, f"{path}/v={number}")
        fs.delete(where, True)
        _give_up(spark, path, number)
    return gone


def read_replaced(
    spark: SparkSession, path: str, version: int | None = None, ddl: str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """A replaced table. Partition columns keep their declared type only with ``ddl``."""
    number = newest_version(spark, path) if version is None else version
    if number is None:
        raise FileNotFoundError(f"no finished version below {path}")
    return read(spark, f"{path}/v={number}", ddl, fmt=fmt)


def write_dimension(current: DataFrame, closed: DataFrame, path: str, base: int | None = None) -> int:
    """Store a merge: closed versions first, then the slice whose presence makes both visible.

    ``base`` is the version that was merged into, -1 for none (by default the newest). Raises
    ``Conflict`` if that is no longer the newest, or if another writer holds the next number.
    """
    spark = current.sparkSession
    last = newest_version(spark, f"{path}/current")
    last = -1 if last is None else last
    version = last + 1
    if (base is not None and base != last) or not claim(spark, f"{path}/current", version):
        raise Conflict(f"another writer is at version {version} of {path}")
    try:
        closed.drop("is_current").write.mode("overwrite").parquet(f"{path}/closed/v={version}")
        current.drop("is_current").write.mode("overwrite").parquet(f"{path}/current/v={version}")
    except Exception:
        _give_up(spark, f"{path}/current", version)
        raise
    return version


#: Rows that a bucket of a slice should have, and the fewest and most buckets.
BUCKET_ROWS, BUCKETS = 200_000, (16, 4096)

BUCKET = "_bucket"


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def _wanted_buckets(rows: int) -> int:
    return min(max(-(-rows // BUCKET_ROWS), BUCKETS[0]), BUCKETS[1])


def manifest(spark: SparkSession, path: str, version: int) -> dict | None:
    """``key``, ``buckets``, ``rows``, ``schema`` and ``held`` (bucket -> version) of a slice; None if it has no buckets."""
    where = f"{path}/manifest/v={version}"
    if not exists(spark, where):
        return None
    found = json.loads(spark.read.text(where, wholetext=True).first()[0])
    return {**found, "held": {int(b): v for b, v in found["held"].items()}}


def _write_manifest(spark: SparkSession, path: str, version: int, content: dict) -> None:
    fs, where = _folder(spark, f"{path}/manifest/v={version}")
    out = fs.create(where, True)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()


def read_buckets(spark: SparkSession, path: str, held: dict, chosen: Iterable[int] | None = None) -> DataFrame:
    """The slice of a manifest, or only the ``chosen`` buckets of it. Columns that older files lack are NULL."""
    schema = StructType.fromJson(held["schema"])
    wanted = sorted(held["held"] if chosen is None else set(chosen) & set(held["held"]))
    folders = [f"{path}/current/v={held['held'][b]}/{BUCKET}={b}" for b in wanted]
    rows = spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
    return rows.withColumn("is_current", F.lit(True))


def write_merge(merged: Merged, key: str, path: str, as_of: AsOf, base: int) -> int:
    """Store a merge into version ``base`` (-1 for none) of a dimension's slice, writing only buckets it touches.

    Closed versions and manifest come first, then the buckets, whose presence makes all visible. A
    slice without buckets, or with far too few for its rows, is written whole. Raises ``Conflict``
    like ``write_dimension``.
    """
    spark = merged.opened.sparkSession
    last = newest_version(spark, f"{path}/current")
    last = -1 if last is None else last
    version = last + 1
    if base != last or not claim(spark, f"{path}/current", version):
        raise Conflict(f"another writer is at version {version} of {path}")
    try:
        held = manifest(spark, path, base) if base >= 0 else None
        opened, rows = merged.opened, merged.opened.count()
        before = 0 if held is None else held["rows"]
        if held is None or _wanted_buckets(before + rows) > 4 * held["buckets"]:
            buckets, kept_buckets = None, {}
            slice_before = read_current(spark, path, base) if base >= 0 else None
        else:
            buckets = held["buckets"]
            touched = [r[0] for r in opened.select(_bucket(key, buckets)).distinct().collect()]
            kept_buckets = {b: v for b, v in held["held"].items() if b not in touched}
            slice_before = read_buckets(spark, path, held, touched)
        if slice_before is None:
            content, closed = opened, merged.closed
        else:
            kept, closed = parted(slice_before, merged.replaced, key, as_of)
            content = kept.unionByName(opened, allowMissingColumns=True)
        closed.drop("is_current").write.mode("overwrite").parquet(f"{path}/closed/v={version}")
        gone = spark.read.parquet(f"{path}/closed/v={version}").count()
        content = content.drop("is_current")
        if buckets is None:
            if base >= 0 and held is None:
                before = slice_before.count()
            buckets = _wanted_buckets(before + rows)
            touched = [r[0] for r in content.select(_bucket(key, buckets)).distinct().collect()]
        schema = content.schema.jsonValue()
        if held is not None:  # what buckets that are not written have and the others lack
            named = {f["name"] for f in schema["fields"]}
            schema["fields"] += [f for f in held["schema"]["fields"] if f["name"] not in named]
        _write_manifest(
            spark, path, version,
            {"key": key, "buckets": buckets, "rows": before + rows - gone, "schema": schema,
             "held": {**kept_buckets, **dict.fromkeys(touched, version)}},
        )
        dealt = by_folder(content.withColumn(BUCKET, _bucket(key, buckets)), [BUCKET])
        dealt.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/current/v={version}")
    except Exception:
        _give_up(spark, f"{path}/current", version)
        raise
    return version


def release_slices(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete what the newest ``keep`` versions of a dimension's slice do not hold; returns the number of folders."""
    if keep < 1:
        raise ValueError("the newest version is always kept")
    numbers = finished_versions(spark, f"{path}/current")
    needed: dict[int, set[int]] = {}
    for number in numbers[-keep:]:
        for bucket, version in ((manifest(spark, path, number) or {}).get("held") or {}).items():
            needed.setdefault(version, set()).add(bucket)
    gone = 0
    for number in numbers[:-keep]:
        fs, where = _folder(spark, f"{path}/current/v={number}")
        if number not in needed:
            fs.delete(where, True)
            gone += 1
        else:
            names = [entry.getPath() for entry in fs.listStatus(where) if entry.getPath().getName().startswith(f"{BUCKET}=")]
            for folder in names:
                if int(folder.getName().split("=")[1]) not in needed[number]:
                    fs.delete(folder, True)
                    gone += 1
        for left in (f"{path}/manifest/v={number}", _claim_path(f"{path}/current", number)):
            fs, where = _folder(spark, left)
            fs.delete(where, False)
    return gone


def read_current(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """Only the current versions, of the newest or a given merge, whatever the length of the history."""
    if version is None:
        version = newest_version(spark, f"{path}/current")
    if version is None:
        return None
    held = manifest(spark, path, version)
    if held is not None:
        return read_buckets(spark, path, held)
    return read_replaced(spark, f"{path}/current", version).withColumn("is_current", F.lit(True))


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All versions. Columns added over time are NULL where older folders lack them."""
    version = newest_version(spark, f"{path}/current")
    if version is None:
        raise FileNotFoundError(f"no dimension below {path}")
    current = read_current(spark, path, version).drop("is_current")
    closed = (
        spark.read.schema(StructType([*current.schema.fields, StructField("v", IntegerType())]))
        .parquet(f"{path}/closed")
        .filter(F.col("v") <= version)
        .drop("v")
        .withColumn("is_current", F.lit(False))
    )
    return current.withColumn("is_current", F.lit(True)).unionByName(closed)


def read_newest_partition(spark: SparkSession, path: str, column: str, ddl: str) -> DataFrame:
    """Only the folder with the highest value of a text partition column.

    The folder names tell the value, so neither the files of older partitions are listed nor their
    footers read. A table without partitions is returned as it is, empty.
    """
    fs, where = _folder(spark, path)
    names = [entry.getPath().getName() for entry in fs.listStatus(where)] if fs.exists(where) else []
    values = [n.split("=", 1)[1] for n in names if n.startswith(f"{column}=") and NULL_PARTITION not in n]
    if not values:
        return read(spark, path, ddl)
    declared = struct_of(ddl)
    reader = spark.read.schema(declared).option("basePath", path)
    return reader.parquet(f"{path}/{column}={max(values)}").select(*declared.names)


def _is_replaced(spec: TableSpec) -> bool:
    return spec.tier == "gold" or spec is CATALOG


def _is_dimension(spec: TableSpec) -> bool:
    return spec in (ITEM_DIM, REVIEW_DIM)


def read_table(spark: SparkSession, spec: TableSpec, root: str) -> DataFrame:
    """A registered table with its declared columns, whatever its layout; dimensions with all versions."""
    path = spec.path(root)
    if _is_dimension(spec):
        return read_history(spark, path)
    if _is_replaced(spec):
        return read_replaced(spark, path, ddl=spec.ddl)
    return read(spark, path, spec.ddl)


def create_empty(spark: SparkSession, spec: TableSpec, root: str) -> None:
    """Lay down a declared table without rows."""
    path = spec.path(root)
    empty = empty_table(spark, spec)
    if _is_dimension(spec):
        write_dimension(empty, empty, path)
    elif _is_replaced(spec):
        replace(empty, path, spec.partition_by)
    else:
        append(empty, path, spec.partition_by)
