from __future__ import annotations

from pathlib import Path
from types import SimpleNamespace
from urllib.parse import urlparse

import pytest

from tierkeep.session import cut, scratch, scratch_path, shared_folder


def session(master, named=None, current=None):
    conf = SimpleNamespace(get=lambda key, default=None: named if key == "spark.checkpoint.dir" else default)
    made = []
    context = SimpleNamespace(
        master=master, getConf=lambda: conf, getCheckpointDir=lambda: made[-1] if made else current, setCheckpointDir=made.append
    )
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_the_named_folder_is_used():
    assert shared_folder(session("yarn", named="hdfs:///shared")) == "hdfs:///shared"
    first, second = (scratch_path(session("yarn", named="hdfs:///shared/"), "kept") for _ in range(2))
    assert first.startswith("hdfs:///shared/kept-") and first != second


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("spark://host:7077"))


def test_a_local_session_gets_one_folder_of_its_own():
    local = session("local[2]")
    assert shared_folder(local) == shared_folder(local)


def test_cut_rows_keep_their_schema_and_forget_their_making(spark):
    rows = spark.sql("select id, array(struct(id as a)) s, timestamp_ntz'2024-01-01' t, cast(null as string) n from range(5)")
    kept = cut(rows)
    assert kept.schema.simpleString() == rows.schema.simpleString()
    assert sorted(map(str, kept.collect())) == sorted(map(str, rows.collect()))
    assert "Range" not in kept._jdf.queryExecution().executedPlan().toString()


def folder(table):
    return Path(urlparse(table.inputFiles()[0]).path).parent


def test_tables_of_a_scratch_block_are_deleted_but_for_kept_ones(spark):
    before = cut(spark.range(3))
    with scratch(spark) as keep_outer:
        with scratch(spark) as keep:
            lost, kept = cut(spark.range(4)), keep(cut(spark.range(5)))
            gone = folder(lost)
        assert not gone.exists() and kept.count() == 5
        last = folder(kept)
        result = keep_outer(cut(spark.range(6)))
    assert not last.exists()
    assert before.count() == 3 and result.count() == 6


def test_an_error_deletes_nothing(spark):
    with pytest.raises(ValueError):
        with scratch(spark):
            table = cut(spark.range(4))
            raise ValueError
    assert table.count() == 4
