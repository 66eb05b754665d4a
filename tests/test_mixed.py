"""Scans that need more than one response, and a whole run over them."""

import json
import random

from pyspark.sql import functions as F

from renown import params as P
from renown.plans.pipeline import run_from_responses
from renown.sources import mixed as M

SCHEMA = ("source string, query string, target string, retrieved_at string, response string, response_seq int, _kind string, "
          "_language string, _page string, _video_id string")
LONG = "A text that is long enough to pass the quality gate of the run, number "


def _feed(*entries):
    return "<rss><channel>" + "".join(f"<item><title>{t}</title><link>{u}</link><pubDate>{d}</pubDate><description>{LONG}{t}</description></item>"
                                      for t, u, d in entries) + "</channel></rss>"


def _rows(*rows):
    full = []
    for r in rows:
        source, query, body = r[:3]
        x = r[3] if len(r) > 3 else {}
        full.append((source, query, "Acme", x.get("at", "2026-04-01T10:00:00+00:00"), body if isinstance(body, str) else json.dumps(body),
                     x.get("seq", 0), x.get("kind"), x.get("lang"), x.get("page"), x.get("video")))
    return full


def _comments(video, n):
    return {"items": [{"snippet": {"totalReplyCount": i, "topLevelComment": {"id": f"{video}-{i}", "snippet": {
        "textDisplay": f"{LONG}{video} {i}", "publishedAt": "2026-03-01T00:00:00Z", "authorDisplayName": "N"}}}} for i in range(n)]}


def responses(spark):
    sections = [{"line": "Talk one", "level": "2", "anchor": "Talk_one", "index": "1"}]
    return spark.createDataFrame(_rows(
        ("bbc", "Acme war", _feed(("War a", "b/1", "Mon, 20 Apr 2026"), ("peace", "b/2", "Wed, 08 Apr 2026"))),
        ("bbc", "Acme war", _feed(("war again", "b/3", "Wed, 08 Apr 2026"), ("war", "b/1", "Thu, 30 Apr 2026")), {"seq": 1}),
        ("ansa", "Acme war", "<rss><chan", {"seq": 3}),
        ("gnews_it", "Acme war", _feed(("x one", "g/1", "d"), ("y two", "g/2", "d"), ("z", "g/3", "d"))),
        ("youtube", "Acme war", {"items": [{"id": {"videoId": "v1"}, "snippet": {"title": "Video one title", "description": LONG}},
                                           {"id": {"videoId": "v2"}, "snippet": {"title": "Video two title", "description": LONG}}]}),
        ("youtube", "Acme war", {"items": [{"id": "v1", "statistics": {"viewCount": "5", "likeCount": "1", "commentCount": "2"}}]},
         {"kind": "statistics", "at": "2026-03-01T00:00:00Z", "seq": 1}),
        ("youtube", "Acme war", {"items": [{"id": "v1", "statistics": {"viewCount": "9", "likeCount": "3", "commentCount": "4"}}]},
         {"kind": "statistics", "at": "2026-03-02T00:00:00Z", "seq": 2}),
        ("youtube", "Acme war", {"items": [{"id": "v1", "statistics": {"viewCount": "99"}}]},
         {"kind": "statistics", "at": "2026-05-02T00:00:00Z", "seq": 3}),
        ("youtube_comments", "Acme war", {"items": [{"id": {"videoId": v}, "snippet": {"title": v}} for v in ("v1", "", "v3", "v4")]},
         {"kind": "search"}),
        *[("youtube_comments", "Acme war", _comments(v, 9), {"kind": "comments", "video": v}) for v in ("v1", "v3", "v4")],
        ("wikitalk", "Acme war", {"parse": {"sections": sections}}, {"page": "Acme Corp", "lang": "en"}),
        ("wikitalk", "Acme war", {"parse": {"wikitext": {"*": "intro\n== Talk one ==\n" + LONG * 2}}},
         {"page": "Acme Corp", "lang": "en", "seq": 1}),
        ("wikitalk", "Acme deal", {"parse": {"title": "Talk:ACME CORP", "sections": sections, "wikitext": {"*": "== Talk one ==\n" + LONG * 2}}}),
        ("wikitalk", "Acme deal", {"parse": {"sections": sections}}, {"page": "Half", "lang": "de"}),
        ("wikipedia", "Acme war", {"title": "Acme", "missing": True}, {"lang": "it"}),
        ("wikipedia", "Acme war", {"title": "Acme", "summary": LONG, "url": "https://en.wiki/Acme"}, {"lang": "en"}),
        ("wikipedia", "Acme deal", {"title": "ACME", "summary": LONG, "url": "https://en.wiki/Acme"}, {"lang": "en"}),
        ("wikipedia", "Acme deal", {"title": "Acme Spa", "summary": LONG, "url": "https://it.wiki/Acme_Spa"}, {"lang": "it"}),
    ), SCHEMA)


def test_run_over_sources_of_several_responses(spark):
    redirects = spark.createDataFrame([("g/1", "https://real.example/a"), ("g/2", "https://consent.google.com/x")], "link string, final_url string")
    params = P.RunParams(target="Acme", queries=("Acme war", "Acme deal"), max_results=7, as_of="2026-04-08")
    raw, bad = M.scan_run(responses(spark), list(params.queries), 7, redirects=redirects, as_of="2026-04-08")
    got = {}
    for r in raw.collect():
        got.setdefault((r.source, r.query[5:]), []).append((r.position, json.loads(r.payload)))
    got = {k: [p for _, p in sorted(v, key=lambda x: x[0])] for k, v in got.items()}
    assert [p["link"] for p in got["bbc", "war"]] == ["b/3", "b/1"] and got["bbc", "war"][1]["title"] == "War a"
    assert [p["link"] for p in got["gnews_it", "war"]] == ["https://real.example/a", "g/2", "g/3"]
    assert [(p["rank"], p["statistics"].get("viewCount")) for p in got["youtube", "war"]] == [(1, "9"), (2, None)]
    # three videos, one without an id: 7 // 3 comments each
    assert [p["comment"]["id"] for p in got["youtube_comments", "war"]] == ["v1-0", "v1-1", "v3-0", "v3-1"]
    assert got["youtube_comments", "war"][1]["reply_count"] == 1
    assert [p["url"] for p in got["wikitalk", "war"]] == ["https://en.wikipedia.org/wiki/Talk:Acme_Corp#Talk_one"]
    assert ("wikitalk", "deal") not in got                      # taken by the first query
    assert got["wikipedia", "war"][0]["url"] == "https://en.wiki/Acme"
    assert got["wikipedia", "deal"][0]["title"] == "Acme Spa"   # it comes first and is free
    assert sorted((r.source, r.reject_reason) for r in bad.collect()) == [("ansa", "invalid_response"), ("wikitalk", "missing_wikitext")]

    res = run_from_responses(responses(spark), params, redirects=redirects)
    recs = res.records.collect()
    assert {r.source for r in recs} == {"bbc", "gnews_it", "youtube", "youtube_comments", "wikitalk", "wikipedia"}
    video = next(r for r in recs if r.url.endswith("v1") and r.source == "youtube")
    assert (video.views_count, video.likes_count, video.comments_count) == (9, 3, 4)
    dry = run_from_responses(responses(spark), P.RunParams(target="Acme", queries=params.queries, dry_run=True, as_of="2026-04-08"))
    n = {r.source: r["count"] for r in dry.records.groupBy("source").count().collect()}
    assert n["bbc"] == n["gnews_it"] == n["youtube"] == n["youtube_comments"] == 1


def test_pages_are_assigned_like_a_sequential_scan(spark):
    draw = random.Random(5)
    rows = [(g, t, p, f"k{draw.randrange(4)}", draw.random() < 0.6) for g in "ab" for t in range(12) for p in range(draw.randrange(4))]
    rows += [("hot", t, 0, "same", True) for t in range(300)]
    want = set()
    for g in {r[0] for r in rows}:
        taken = set()
        for t in sorted({r[1] for r in rows if r[0] == g}):
            for _, _, p, k, e in sorted(r for r in rows if r[:2] == (g, t)):
                if k in taken:
                    break
                if e:
                    taken.add(k)
                    want.add((g, t, p))
                    break
    df = spark.createDataFrame(rows, "g string, t int, p int, k string, e boolean")
    got = M.assign_in_order(df, "g", "t", "p", "k", "e").collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert M.assign_in_order(df.limit(0), "g", "t", "p", "k", "e").count() == 0


def test_no_responses(spark):
    raw, bad = M.scan_run(responses(spark).limit(0), ["q"], 5)
    assert raw.count() == bad.count() == 0
    plain = responses(spark).drop("_kind", "_language", "_page", "_video_id", "response_seq").where(F.col("source") == "bbc")
    assert M.scan_run(plain, ["Acme war"], 5)[0].count() == 2
