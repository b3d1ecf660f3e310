"""Run registered queries against their SQL: ``python tests/check_queries.py [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as spark_entry
from tests.compare import connect, differences
from tierkeep.session import local_session


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(spark_entry.queries())
    spark = local_session(cpus=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles, failed = spark_entry.oracle_sql(), 0
    for name in names:
        begun = time.monotonic()
        try:
            df = spark_entry.queries()[name](spark, sf_dir)
            if name in oracles:
                found = differences(df, oracles[name], con)
            else:
                found = [] if df.count() else ["no rows"]
        except Exception as problem:
            found = [f"{type(problem).__name__}: {str(problem)[:1500]}"]
        failed += bool(found)
        mark = "FAIL" if found else ("ok" if name in oracles else "ok (rows only)")
        print(f"{mark:6} {name} {time.monotonic() - begun:.2f}s {' | '.join(found)}", flush=True)
    print(f"{len(names)} queries, {failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
