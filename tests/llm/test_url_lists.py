from __future__ import annotations

import datetime as dt

from tests.compare import connect, differences
from tierkeep.llm import url_lists
from tierkeep.llm.queries import ORACLES, QUERIES


def at(day: int) -> dt.datetime:
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day)


def test_equals_sql(spark, sf_dir):
    name = "op4_url_filters"
    assert differences(QUERIES[name](spark, sf_dir), ORACLES[name], connect(sf_dir)) == []


def test_active_at_fetch_time(spark):
    changes = spark.createDataFrame(
        [("a.example.org", "block", at(10), 0), ("a.example.org", "block", at(12), 0), ("a.example.org", "remove", at(20), 0),
         ("a.example.org", "allow", at(60), 1), ("a.example.org", "block", at(60), 2), ("example.org", "allow", at(0), 0),
         ("a.example.org/x", "allow", at(11), 0), (None, "block", at(0), 0), ("a.example.org", None, at(1), 0),
         ("a.example.org", "block", None, 0)],
        "key string, action string, changed_at timestamp_ntz, change_no int",
    )
    captures = spark.createDataFrame(
        [(1, "http://A.example.org:80/", at(9), "h"), (2, "http://a.example.org/y", at(10), None), (3, "http://a.example.org/x?q", at(11), "h"),
         (4, "https://u:p@a.example.org/y", at(20), "h"), (5, "http://a.example.org", at(300), "h"), (6, None, at(1), "h"),
         (7, "http://a.example.org/y", None, "h"), (8, "not a url", at(15), "h"), (2, "http://a.example.org/y", at(10), None)],
        "page_id bigint, url string, fetched_at timestamp_ntz, _row string",
    )
    out = url_lists.judged(captures, changes)
    assert out.columns[:4] == captures.columns
    got = sorted((r.page_id, r.verdict, r.rule, r.listed_from, r.listed_to, r.n_active) for r in out.collect())
    org, host = "example.org", "a.example.org"
    assert got == [
        (1, "allow", org, at(0), None, 1),
        (2, "block", host, at(10), at(20), 2),
        (2, "block", host, at(10), at(20), 2),
        (3, "allow", f"{host}/x", at(11), None, 3),
        (4, "allow", org, at(0), None, 1),
        (5, "block", host, at(60), None, 2),
        (6, "unlisted", None, None, None, 0),
        (7, "unlisted", None, None, None, 0),
        (8, "unlisted", None, None, None, 0),
    ]
    assert url_lists.judged(captures.limit(0), changes).count() == 0
    assert url_lists.judged(captures, changes.limit(0)).where("verdict <> 'unlisted'").count() == 0
