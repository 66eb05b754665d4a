"""URL rules against plain Python, and the trees on held-out URLs."""

import pytest
from pyspark.sql import functions as F

from renown.llm import url_filter
from renown.llm.url_filter import RULES, Rule

PAGES = "/root/testdata/sf0.01/pages.parquet"
ODD = [None, "", "no scheme/x", "://", "http://", "HTTP://A.B.EXAMPLE.COM/en/x", "https://www.example.com/en/?q=1#z",
       "http://sub.www.example.com/en/", "http://example.com", "http://example.com?x/en/", "http://notexample.com/en/",
       "http://example.com/EN/", "x://y://z.net/es/", "http://net/es/a", "http://a.net/fr", "http://a.net/fr/#/en/",
       "http://com/", "http://.com/", "http://user@a.com:80/en/", "http://é.example.net/es/" + "a1-" * 20000, "http://com./",
       "http://" + "a." * 3000 + "net/fr/x?" + "p=1&" * 500]


def plain(url, rules=RULES):
    rest = (url or "").partition("://")[2]
    cut = min([i for c in "/?#" if (i := rest.find(c)) >= 0], default=len(rest))
    host, tail = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
    path = tail[:min([i for c in "?#" if (i := tail.find(c)) >= 0], default=len(tail))]
    fits = [r for r in rules if host and (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=lambda r: len(r.text)) if fits else None


def test_rules(spark):
    sure = spark.read.parquet(PAGES).select("url")
    urls = ODD + [r.url for r in sure.collect()]
    data = spark.createDataFrame([(i, u, "clash", 1.0) for i, u in enumerate(urls + urls[:5])],
                                 "page_id long, url string, host string, score double").repartition(3)
    got = {r.page_id: r for r in url_filter.judge(data).collect()}
    assert len(got) == len(urls) + 5
    for i, u in enumerate(urls + urls[:5]):
        host, path, rule = plain(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule and rule.text), u
        assert got[i].verdict == (rule.verdict if rule else "block" if got[i].score >= 0.5 else "allow")
        assert 0 <= got[i].score <= 1
    assert all(got[i].score == got[len(urls) + i].score for i in range(5))


def test_trees_on_held_out_urls(spark):
    """Labels that the lexical features can tell; the trees are fitted on ten elevenths of the URLs."""
    rows = [(i, f"http://h{i % 40}.{'net' if i % 3 else 'org'}/" + ("a/b/c/" if i % 2 else "") + ("?x=1&y=2" if i % 5 else "")
             + "9" * (i % 7)) for i in range(1500)]
    data = spark.createDataFrame(rows, "page_id long, url string")
    prepared, suffixes = url_filter.prepare(data, ())
    bad = (F.col("depth") >= 3) & (F.col("parameters") > 0) | (F.col("digit_ratio") > 0.2)
    marked = prepared.withColumn("ruling", F.struct(F.lit("").alias("rule"), F.when(bad, "block").otherwise("allow").alias("verdict")))
    model = url_filter.train(marked.filter("page_id % 11 <> 0"), suffixes)
    held = url_filter.score(marked.filter("page_id % 11 = 0"), suffixes, model)
    right = held.select(((F.col("score") >= 0.5) == (F.col("ruling.verdict") == "block")).alias("ok"))
    assert right.filter("ok").count() / right.count() > 0.95


@pytest.mark.parametrize("rules, verdict", [((), "allow"), ((Rule("block", "b", "/"),), "block"), ((Rule("allow", "b", "/"),), "allow")])
def test_without_two_verdicts(spark, rules, verdict):
    data = spark.createDataFrame([(1, "http://a/x"), (2, "http://b/x")], "page_id long, url string")
    rows = {r.page_id: r for r in url_filter.judge(data, rules).collect()}
    assert rows[1].verdict == verdict and rows[1].rule is None and rows[2].rule == ("b/" if rules else None)
    assert url_filter.judge(data.limit(0), rules).count() == 0


def test_ties_of_rules(spark):
    data = spark.createDataFrame([(1, "http://x.aa/b/c")], "page_id long, url string")
    both = (Rule("block", "aa", "/b/c"), Rule("allow", "x.aa", "/b"))
    assert [url_filter.judge(data, r).first().verdict for r in (both, both[::-1])] == ["block", "allow"]
