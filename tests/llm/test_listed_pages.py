"""Listed pages, and rules that no page can fit."""

from __future__ import annotations

import pytest

from skyledger.llm import urls


def test_listed_pages(spark):
    rules = [("example.com/de/x.html", "block"), ("example.com/", "allow"), ("b.org/a", "block")]
    listed = spark.createDataFrame(rules, "rule string, verdict string")
    pages = ["http://Example.com/de/x.html?q", "http://example.com/de/x.htm", "http://a.example.com/de/x.html"]
    pages += ["http://b.org/a", "http://b.org/a/", "http://b.org/ab"]
    rows = spark.createDataFrame(list(enumerate(pages)), "page_id long, url string")
    found = {r["page_id"]: r["rule"] for r in urls.judge(rows, listed).collect()}
    assert found == {0: rules[0][0], 1: rules[1][0], 2: rules[1][0], 3: "b.org/a", 4: None, 5: None}


@pytest.mark.parametrize("rule", ["net", "/x/", "Net/", "net/?q"])
def test_rules_that_fit_nothing(spark, rule):
    listed = spark.createDataFrame([(rule, "block")], "rule string, verdict string")
    pages = spark.createDataFrame([(1, "http://net/")], "page_id long, url string")
    with pytest.raises(ValueError):
        urls.judge(pages, listed)
