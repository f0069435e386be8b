from __future__ import annotations

import re

import pytest
from hard_texts import MIDDLE, SMALL

from linkloom.llm import queries, urls

ODD = [
    None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.COM/en/x?y", "http://example.com/EN/",
    "http://sub.www.example.com/en/", "http://example.com", "http://example.com?/en/", "http://notexample.com/en/",
    "http://a.net/es/1#x", "http://a.net/es", "x://y://z/en/", "http://ÄB.com/", "http://com/", "http://net/fr/\n",
    "http://a.b/" + "x" * 20_000 + "?a=1&b=2",
]


def expected(url: str | None) -> tuple:
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host = re.sub("[A-Z]", lambda x: x[0].lower(), m[1]) if m else ""
    path = m[2] if m else ""
    fits = [
        r for r in queries.URL_RULES
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    rule = max(fits, key=lambda r: len(r.host + r.path), default=None)
    return host, path, rule and rule.host + rule.path, rule and ("allow" if rule.allow else "block")


def check(rows, key):
    learned = set()
    for row in rows:
        host, path, rule, verdict = expected(key(row))
        assert (row.host, row.path, row.rule) == (host, path, rule)
        if rule:
            assert row.verdict == verdict
        else:
            learned.add(row.verdict)
    assert learned <= {"allow", "block"}


def test_odd_urls(spark):
    table = spark.createDataFrame([(i, u) for i, u in enumerate(ODD * 2)], "page_id int, url string")
    table = table.selectExpr("*", "'mine' AS host", "1 AS _n", "'r' AS rule", "2 AS `a.b`")
    made = urls.judge(table, queries.URL_RULES, trees=2)
    assert sorted(made.columns) == sorted([*table.columns, "path", "verdict"])
    check(made.collect(), lambda r: r.url)
    assert made.count() == len(ODD) * 2


def test_without_labelled_urls_of_both_kinds(spark):
    table = spark.createDataFrame([(1, "http://a.org/"), (2, "http://a.com/")], "page_id int, url string")
    assert {r.verdict for r in urls.judge(table, queries.URL_RULES).collect()} == {"allow"}
    assert urls.judge(table.limit(0), queries.URL_RULES).count() == 0


def test_copies_of_a_url_take_one_place_of_the_sample(spark):
    rows = [("http://a.com/x", 1.0, True)] * 50 + [(f"http://b.com/{i}", 2.0, False) for i in range(5)]
    frame = spark.createDataFrame(rows, "url string, f double, rule_allows boolean")
    made = urls._labelled(frame, ["f"], 0.5, 3.0, 6).collect()
    assert sorted((r.f, r.label, r.weight) for r in made) == [(1.0, 0.0, 25.0)] + [(2.0, 1.0, 3.0)] * 5


def test_trees_learn_what_urls_look_like(spark):
    """Rules name some hosts; held-out hosts of the same looks are judged by the trees."""
    good = [f"http://site{i % 7}.org/a/page-{'abcdefgh'[i % 8]}" for i in range(300)]
    bad = [f"http://h{i % 7}.biz/{i * 7919}/{i * 104729}?a=1&b=2&c={i}" for i in range(300)]
    rules = [urls.Rule(f"site{k}.org", "/", True) for k in range(5)] + [urls.Rule(f"h{k}.biz", "/", False) for k in range(5)]
    table = spark.createDataFrame([(u,) for u in good + bad], "url string")
    rows = urls.judge(table, rules, trees=5).where("rule IS NULL").collect()
    right = sum((r.verdict == "allow") == r.host.endswith(".org") for r in rows)
    assert len(rows) > 100 and right / len(rows) > 0.95


@pytest.mark.parametrize("sf_dir", [SMALL, MIDDLE])
def test_query(spark, sf_dir):
    table = {r.page_id: r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = queries.op6_url_filter(spark, sf_dir).collect()
    assert len(rows) == len(table)
    check(rows, lambda r: table[r.page_id])
