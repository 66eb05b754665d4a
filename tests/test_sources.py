"""Landed-response scans: ranks, caps, fallbacks, quotas, RSS order, talk sections."""

import json

import pytest
from pyspark.sql import functions as F

from renown.sources import landed as L


def test_explode_rank_before_filter_and_cap(spark):
    resp = json.dumps({"web": {"results": [{"url": "a"}, {"url": ""}, {"url": "c"}, {"url": "d"}]}})
    df = spark.createDataFrame([("brave", "q", resp), ("brave", "q2", "{bad")], "source string, query string, response string")
    out = L.explode_items(df, "$.web.results", cap=3, keep_item="$.url").orderBy("rank").collect()
    assert [(r.query, r.rank) for r in out] == [("q", 1), ("q", 3)]


def test_fallback_only_for_empty_keys(spark):
    pref = spark.createDataFrame([("q1", 1)], "query string, id int")
    fb = spark.createDataFrame([("q1", 9), ("q2", 2)], "query string, id int")
    got = sorted((r.query, r.id) for r in L.with_fallback(pref, fb, ["query"]).collect())
    assert got == [("q1", 1), ("q2", 2)]


def test_comments_quota(spark):
    videos = spark.createDataFrame([("q", 1, "v1"), ("q", 2, None), ("q", 3, "v3"), ("q", 4, "v4")],
                                   "query string, video_rank int, video_id string")
    comments = spark.createDataFrame([(v, p) for v in ("v1", "v3", "v4") for p in range(1, 10)],
                                     "video_id string, position int")
    out = L.comments_with_quota(videos, comments, max_results=7, max_videos=3, group=("query",)).collect()
    # 3 search results (one without id) -> quota 7 // 3 = 2 per video; v4 is outside the top 3
    assert sorted((r.video_id, r.position) for r in out) == [("v1", 1), ("v1", 2), ("v3", 1), ("v3", 2)]


def test_rss_parse_and_topk_text_order(spark):
    doc = ("<rss><channel>"
           "<item><title>War news</title><link>l1</link><pubDate>Mon, 20 Apr 2026</pubDate></item>"
           "<item><title>war again</title><link>l2</link><pubDate>Wed, 08 Apr 2026</pubDate></item>"
           "<item><title>war dup</title><link>l1</link><pubDate>Thu, 30 Apr 2026</pubDate></item>"
           "<item><title>peace</title><link>l3</link><pubDate>Tue, 01 Apr 2026</pubDate></item>"
           "</channel></rss>")
    feeds = spark.createDataFrame([("bbc", "the war", doc)], "source string, query string, response string")
    items = L.parse_rss(feeds).withColumn("ord", F.col("item_pos"))
    top = L.rss_top_k(items, 5, 2, group=("source", "query")).orderBy("rank").collect()
    assert [r.link for r in top] == ["l2", "l1"]


def test_talk_sections(spark):
    wikitext = ("intro\n== First ==\n" + "x" * 60 + " [[A|b]]\n== Only template ==\n{{tmpl|a}}\n"
                "== Short ==\nhi\n== Third ==\n" + "y" * 55 + " ~~~~")
    meta = [{"line": "First", "level": 2, "anchor": "First", "index": "1"},
            {"line": "Only template", "level": 2, "anchor": "Only_template", "index": "2"},
            {"line": "Short", "level": 2, "anchor": "Short", "index": "3"},
            {"line": "Third", "level": 2, "anchor": None, "index": "4"}]
    df = spark.createDataFrame([("Some Page", "en", wikitext, meta)],
                               "page_title string, lang string, wikitext string, "
                               "sections array<struct<line:string,level:int,anchor:string,index:string>>")
    out = L.talk_sections(df, max_results=10).collect()
    assert [r.section_title for r in out] == ["First", "Third"]
    assert out[0].url == "https://en.wikipedia.org/wiki/Talk:Some_Page#First"
    assert out[0].wikitext.endswith(" b")


def test_scan_landed_then_normalize(spark):
    from renown.operators.normalize import accepted, normalize
    rows = [
        ("news", json.dumps({"status": "ok", "articles": [{"title": "a", "url": "https://x/1"},
                                                          {"title": "b", "url": ""}]}), None, None, None),
        ("news", json.dumps({"status": "error", "message": "rate limited"}), None, None, None),
        ("reddit", json.dumps({"data": {"children": [{"data": {"permalink": "/r/a/1", "title": "r"}}]}}),
         None, None, None),
        ("lemmy", json.dumps({"comments": [{"comment": {"content": "c", "ap_id": "https://l/1"},
                                            "creator": {"name": "n"}, "counts": {}}]}), "lemmy.ml", "Comments", None),
        ("mastodon", json.dumps([{"content": "<p>x</p>", "url": "https://m/1", "account": {"acct": "a"}}]),
         "mastodon.social", None, "tag"),
        ("guardian", json.dumps({"response": {"results": [{"webTitle": "g", "webUrl": "https://g/1", "fields": {}}]}}),
         None, None, None),
    ]
    df = spark.createDataFrame([(s, "q", "T", "2026-04-08", r, i, c, h) for s, r, i, c, h in rows],
                               "source string, query string, target string, retrieved_at string, response string, "
                               "_instance string, _content_type string, _hashtag_fallback string")
    raw = L.scan_landed(df, 20)
    assert sorted(r.source for r in raw.collect()) == ["guardian", "lemmy", "mastodon", "news", "reddit"]
    g = raw.where(F.col("source") == "guardian").collect()[0]
    assert json.loads(g.payload)["_rank"] == 1
    recs = accepted(normalize(raw.withColumn("ord", F.monotonically_increasing_id())))
    got = {r.source: (r.url, r.domain) for r in recs.collect()}
    assert got["reddit"] == ("https://www.reddit.com/r/a/1", "www.reddit.com")
    assert got["lemmy"] == ("https://l/1", "lemmy.ml") and got["mastodon"][1] == "mastodon.social"


def test_resolve_links_and_task_order(spark):
    items = spark.createDataFrame([(1, "g/1"), (2, "g/2"), (3, "g/3")], "id int, link string")
    red = spark.createDataFrame([("g/1", "https://real.example/a"), ("g/2", "https://consent.google.com/x")],
                                "link string, final_url string")
    got = {r.id: r.link for r in L.resolve_links(items, red).collect()}
    assert got == {1: "https://real.example/a", 2: "g/2", 3: "g/3"}
    raw = spark.createDataFrame([("gdelt", "b", 0, 1), ("news", "b", 0, 2), ("news", "a", 1, 1), ("news", "a", 0, 5)],
                                "source string, query string, response_seq int, position int")
    rows = L.with_order(raw, ["a", "b"]).orderBy("ord").collect()
    assert [(r.source, r.query, r.response_seq, r.position) for r in rows] == [
        ("news", "a", 0, 5), ("news", "a", 1, 1), ("news", "b", 0, 2), ("gdelt", "b", 0, 1)]


_RESP = ("source string, query string, target string, retrieved_at string, response string, _instance string, "
         "_hashtag_fallback string, _any_language boolean")


def _resp(spark, rows):
    return spark.createDataFrame([(s, "q", "T", "2026-04-08", r, i, h, a) for s, r, i, h, a in rows], _RESP)


def test_scan_keeps_what_landed_and_slices_where_the_source_does(spark):
    news = {"articles": [{"url": f"https://n/{i}"} for i in range(30)]}
    nyt = {"response": {"docs": [{"web_url": f"https://y/{i}"} for i in range(30)]}}
    df = _resp(spark, [("news", json.dumps(news), None, None, None), ("nyt", json.dumps(nyt), None, None, None)])
    n = {r.source: r["count"] for r in L.scan_landed(df, 20).groupBy("source").count().collect()}
    assert n == {"news": 30, "nyt": 20}
    n = {r.source: r["count"] for r in L.scan_landed(df, 1, slice_all=True).groupBy("source").count().collect()}
    assert n == {"news": 1, "nyt": 1}


def test_fallbacks_errors_and_tags(spark):
    art = json.dumps({"articles": [{"url": "https://n/1"}]})
    post = {"url": "https://m/1", "_instance": "old"}
    df = _resp(spark, [
        ("news", json.dumps({"articles": []}), None, None, None), ("news", art, None, None, True),
        ("mastodon", json.dumps({"statuses": [post]}), "a", None, None),
        ("mastodon", json.dumps([{"url": "https://m/2"}]), "a", "tag", None),
        ("mastodon", json.dumps({"statuses": []}), "b", None, None),
        ("mastodon", json.dumps([{"url": "https://m/3"}]), "b", "tag", None),
        ("stackexchange", json.dumps({"error_id": 502, "items": [{"title": "x"}]}), None, None, None),
        ("gdelt", "no json {", None, None, None), ("bluesky", None, None, None, None),
        ("youtube", json.dumps({"items": [{"id": {"videoId": "v"}}]}), None, None, None)])
    got = {(r.source, r.payload) for r in L.scan_landed(df, 20).collect()}
    assert sorted((s, json.dumps(json.loads(p), sort_keys=True)) for s, p in got) == sorted([
        ("news", '{"url": "https://n/1"}'),
        ("mastodon", '{"_instance": "a", "url": "https://m/1"}'),
        ("mastodon", '{"_hashtag_fallback": "tag", "_instance": "b", "url": "https://m/3"}'),
        ("youtube", '{"id": {"videoId": "v"}, "rank": 1}')])
    assert sorted((r.source, r.reject_reason) for r in L.rejected_responses(df).collect()) == [
        ("bluesky", "invalid_response"), ("gdelt", "invalid_response"), ("stackexchange", "error_response")]
    L.require_distinct_responses(df.where("source <> 'news'"))
    with pytest.raises(ValueError):
        L.require_distinct_responses(df)


def test_rss_source_attribute(spark):
    feed = ("<rss><channel><item><title>a</title><link>l/1</link><source url='https://s.example'>S</source></item>"
            "<item><title>b</title><link>l/2</link><source>T</source></item>"
            "<item><title>c</title><link>l/3</link></item></channel></rss>")
    out = L.parse_rss(spark.createDataFrame([(feed,)], "response string")).orderBy("item_pos").collect()
    assert [(r.title, r.source_name, r.source_url) for r in out] == [
        ("a", "S", "https://s.example"), ("b", "T", None), ("c", None, None)]


def test_register_scan(spark):
    L.register_scan("podcasts", L.ScanRule("$.shows"))
    try:
        df = _resp(spark, [("podcasts", json.dumps({"shows": [{"a": 1}, {"a": 2}]}), None, None, None)])
        assert [json.loads(r.payload) for r in L.scan_landed(df, 5).orderBy("position").collect()] == [{"a": 1}, {"a": 2}]
    finally:
        del L.SCAN_RULES["podcasts"]
