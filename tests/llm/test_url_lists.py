from __future__ import annotations

import datetime as dt

from panelops.llm import url_lists
from panelops.llm.url_lists import F

D = dt.date


def test_lists_in_force_when_fetched(spark):
    entries = [
        ("a", "Bad.com", D(2024, 1, 1), "add"), ("a", "bad.com", D(2024, 2, 1), "remove"), ("a", "bad.com", D(2024, 3, 1), "add"),
        ("b", "x.bad.com", D(2024, 1, 15), "add"), ("b", "x.bad.com", D(2024, 1, 15), "add"), ("c", "y.org", D(2024, 1, 1), "add"),
        ("c", "y.org", D(2024, 1, 1), "remove"), (None, "bad.com", D(2024, 1, 1), "add"), ("d", "com", D(2024, 1, 1), "add"),
    ]
    captures = [
        (1, "http://X.bad.com/p?u=http://y.org", D(2024, 1, 1), "b"), (2, "http://x.bad.com:80/", D(2024, 1, 20), ""), (2, "http://x.bad.com:80/", D(2024, 1, 20), ""),
        (3, "https://bad.com", D(2024, 2, 1), ""), (4, "https://u@bad.com.", D(2024, 3, 5), ""), (5, "http://y.org", D(2024, 5, 1), ""), (6, None, D(2024, 1, 20), ""),
        (7, "http://bad.com", None, ""), (None, "http://notbad.com", D(2024, 1, 20), ""), (9, "no url", D(2024, 1, 20), ""),
    ]
    got = url_lists.evaluate(
        spark.createDataFrame(captures, "page_id long, url string, fetched date, lists string"),
        spark.createDataFrame(entries, "list string, pattern string, day date, action string"))
    assert sorted((r.page_id or 0, r.lists, r.blocked) for r in got.collect()) == [
        (0, "", False), (1, "a", True), (2, "a,b", True), (2, "a,b", True), (3, "", False), (4, "a", True), (5, "", False), (6, "", False), (7, "", False), (9, "", False)]


def test_no_rows_and_no_entries(spark):
    pages = spark.createDataFrame([(1, "http://a.b.com")], "page_id long, url string")
    none = spark.createDataFrame([], "list string, pattern string, day date, action string")
    assert [r.blocked for r in url_lists.evaluate(url_lists.dated_captures(pages), none).collect()] == [False]
    empty = pages.limit(0)
    assert url_lists.evaluate(url_lists.dated_captures(empty), url_lists.derived_lists(empty)).collect() == []


def test_plan_has_no_python(spark):
    pages = spark.createDataFrame([(1, "http://a.b.com")], "page_id long, url string")
    plan = url_lists.evaluate(url_lists.dated_captures(pages), url_lists.derived_lists(pages))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and F is not None
