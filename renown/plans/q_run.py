"""Landed runs over every source: responses of all kinds, built from the test tables, through ``scan_run``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from renown import params as P
from renown.plans import oracle as O
from renown.plans.pipeline import scan_selected
from renown.plans.q_sources import _PP, _rss_feeds
from renown.plans.q_talk import _TALK_SQL, _talk_pages
from renown.plans.registry import query
from renown.sources import fixtures as X
from renown.sources import landed as L
from renown.sources import mixed as M

QUERIES = ("the war", "und der", "xyzzy qq")
MAX_RESULTS, MAX_VIDEOS, AS_OF = 5, 3, "2024-01-20"
JSON_SOURCES = tuple(L.SCAN_RULES)
PICKED = ("stackexchange", "hackernews", "nyt", "bbc", "lemmy", "gnews_it")


def _pick(names, number) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (F.pmod(number, F.lit(len(names))) + 1).cast("int"))


def _nest(path: str, value: Column) -> Column:
    """``value`` as a struct at ``path`` ($.a.b)."""
    return reduce(lambda v, k: F.struct(v.alias(k)), reversed(path[2:].split(".")), value)


def _envelope(source: str, rule: L.ScanRule, pages: Column, path: str) -> Column:
    def item(e):
        value = F.when(e["u"] == "", "").otherwise(F.concat(F.lit("v"), (e["page_id"] % 200).cast("string"))) \
            if source == "youtube" else e["u"]
        own = _nest(rule.url_path or "$.url", value)
        return _nest(rule.item_path, own) if rule.item_path else own
    return F.to_json(_nest(path, F.transform(pages, item)))


def _landing(df, **columns):
    known = {"_kind": None, "_content_type": None, "_language": None, "_page": None, "_video_id": None, "response_seq": 0,
             "retrieved_at": X.RETRIEVED_AT} | columns
    return df.select(*[(v if isinstance(v, Column) else F.lit(v)).cast("long" if k == "response_seq" else "string").alias(k)
                       for k, v in known.items()])


def _json_responses(spark, sf_dir):
    seq = F.col("seq")
    pages = X.table(spark, sf_dir, "pages").select(F.expr("page_id div 10").alias("seq"), F.struct(
        "page_id", F.when(F.col("page_id") % 6 == 0, "").otherwise(F.col("url")).alias("u")).alias("p"))
    r = pages.groupBy("seq").agg(F.array_sort(F.collect_list("p")).alias("p")).withColumn("source", _pick(JSON_SOURCES, seq))
    comments = (F.col("source") == "lemmy") & (F.expr("seq div 12") % 2 == 1)
    body = F.when(comments, _envelope("lemmy", L.SCAN_RULES["lemmy"], F.col("p"), "$.comments"))
    for s, rule in L.SCAN_RULES.items():
        body = body.when(F.col("source") == s, _envelope(s, rule, F.col("p"), rule.path))
    return _landing(r, source=F.col("source"), query=_pick(QUERIES, seq), target="Entity", response_seq=seq,
                    _content_type=F.when(comments, "Comments"), response=F.when(seq % 11 == 5, "{cut off").otherwise(body))


def _statistics_responses(spark, sf_dir):
    day = F.to_date("ts")
    views = X.table(spark, sf_dir, "events").groupBy(day.alias("day"), "user_id").agg(F.count("*").alias("n"))
    item = F.struct(F.concat(F.lit("v"), F.col("user_id").cast("string")).alias("id"),
                    F.struct(F.col("n").cast("string").alias("viewCount")).alias("statistics"))
    r = views.groupBy("day").agg(F.to_json(F.struct(F.collect_list(item).alias("items"))).alias("response"))
    return _landing(r, source="youtube", query=QUERIES[0], target="Entity", _kind="statistics", response=F.col("response"),
                    response_seq=F.unix_date("day"), retrieved_at=F.concat(F.col("day").cast("string"), F.lit("T06:00:00+00:00")))


def _feed_responses(spark, sf_dir):
    feed = F.col("feed_id")
    return _landing(_rss_feeds(spark, sf_dir), source=_pick(M.FEEDS, feed), query=_pick(QUERIES, F.expr("feed_id div 3")),
                    target="Entity", response_seq=feed, response=F.col("response"))


def _talk_responses(spark, sf_dir):
    pages = _talk_pages(spark, sf_dir)
    doc = F.col("doc_id")
    title = F.concat(F.when(doc % 2 == 1, "PAGE ").otherwise("Page "), F.expr("doc_id div 3").cast("string"))
    same = {"source": "wikitalk", "query": _pick(QUERIES, doc), "target": F.concat(F.lit("Entity "), F.expr("doc_id div 3").cast("string")),
            "_language": F.col("lang"), "_page": title}
    lists = _landing(pages.where(doc % 17 != 3), **same, _kind=None, response_seq=1,
                     response=F.to_json(F.struct(F.struct("sections").alias("parse"))))
    texts = _landing(pages.where(doc % 13 != 5), **same, _kind=None, response_seq=2,
                     response=F.to_json(F.struct(F.struct(F.struct(F.col("wikitext").alias("*")).alias("wikitext")).alias("parse"))))
    return lists.unionByName(texts)


def _comment_responses(spark, sf_dir):
    conv = X.table(spark, sf_dir, "conversations")
    target = F.concat(F.lit("Entity "), F.expr("conv_id div 12").cast("string"))
    conv = conv.withColumns({"query": _pick(QUERIES, F.col("conv_id")), "target": target})
    video = F.concat(F.lit("v"), F.col("conv_id").cast("string"))
    known = F.col("conv_id") % 11 != 0
    found = conv.where("turn = 0").groupBy("query", "target").agg(F.array_sort(F.collect_list(F.struct(
        "conv_id", F.struct(F.when(known, video).alias("videoId")).alias("id"),
        F.struct(F.concat(F.lit("Title "), video).alias("title")).alias("snippet")))).alias("items"))
    search = _landing(found, source="youtube_comments", query=F.col("query"), target=F.col("target"), _kind="search",
                      response=F.to_json(F.struct("items")))
    threads = conv.where("turn > 0").groupBy("query", "target", "conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "turn", F.struct(F.struct(F.concat(F.lit("c"), F.col("turn").cast("string")).alias("id")).alias("topLevelComment"),
                         F.length("text").alias("totalReplyCount")).alias("snippet")))).alias("items"))
    body = F.when(F.col("conv_id") % 5 == 4, '{"error": {"code": 403}}').otherwise(F.to_json(F.struct("items")))
    return search.unionByName(_landing(threads, source="youtube_comments", query=F.col("query"), target=F.col("target"),
                                       _kind="comments", _video_id=video, response=body))


def _encyclopedia_responses(spark, sf_dir):
    page = F.col("page_id")
    title = F.when(page % 11 == 0, "").otherwise(F.concat(F.when(page % 3 == 0, "t").otherwise("T"),
                                                          F.expr("(page_id * 7 + page_id div 2) % 2").cast("string")))
    body = F.to_json(F.struct(title.alias("title"), F.col("url"), (page % 5 == 0).alias("missing")))
    return _landing(X.table(spark, sf_dir, "pages"), source="wikipedia", query=_pick(QUERIES, F.expr("page_id div 2")),
                    target=F.concat(F.lit("Entity "), F.expr("page_id div 6").cast("string")),
                    _language=F.when(page % 2 == 0, "it").otherwise("en"), response=body)


def _redirects(spark, sf_dir):
    page = F.col("page_id")
    final = F.when(page % 9 == 0, "https://consent.google.com/ml").when(page % 9 == 3, "").otherwise(
        F.concat(F.lit("https://resolved.example/"), page.cast("string")))
    return X.table(spark, sf_dir, "pages").where(page % 3 == 0).select(F.split("url", r"\?").getItem(0).alias("link"),
                                                                       final.alias("final_url"))


def _responses(spark, sf_dir):
    parts = [f(spark, sf_dir) for f in (_json_responses, _statistics_responses, _feed_responses, _talk_responses,
                                        _comment_responses, _encyclopedia_responses)]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _scan(spark, sf_dir):
    return M.scan_run(_responses(spark, sf_dir), list(QUERIES), MAX_RESULTS, redirects=_redirects(spark, sf_dir),
                      as_of=AS_OF, max_videos=MAX_VIDEOS)


_Q = "(['" + "', '".join(QUERIES) + "'])"
_URL_NEEDED = [s for s, r in L.SCAN_RULES.items() if r.url_path]
_RANKED = [s for s, r in L.SCAN_RULES.items() if r.rank_key and s != "youtube"]
_TALK_CTES = _TALK_SQL.split("SELECT doc_id, CAST(i AS VARCHAR) AS section_index")[0].strip().removeprefix("WITH ")
_RSS_TERMS = "CASE source WHEN 'bbc' THEN 2 ELSE 1 END"
_TASK_SQL = f"list_position({list(P.SOURCE_ORDER)}, source) * 3 - 4 + list_position({_Q}, query)"

def _run_sql(most: int, dry: bool = False) -> str:
    """The run's rows with ``most`` results a task; a dry run slices every source."""
    sliced = "true" if dry else "source = 'nyt'"
    return f"""WITH RECURSIVE {_PP.strip()},
j AS (SELECT page_id, page_id // 10 AS seq, url, ({list(JSON_SOURCES)})[(page_id // 10) % 12 + 1] AS source,
             {_Q}[(page_id // 10) % 3 + 1] AS query, row_number() OVER (PARTITION BY page_id // 10 ORDER BY page_id) AS position FROM pages),
views AS (SELECT day, user_id, count(*) AS n FROM (SELECT CAST(ts AS DATE) AS day, user_id FROM events) GROUP BY ALL),
latest AS (SELECT 'v' || user_id AS video_id, arg_max(n, day) AS n FROM views WHERE day <= DATE '{AS_OF}' GROUP BY user_id),
j1 AS (SELECT *, CASE WHEN page_id % 6 = 0 THEN '' WHEN source = 'youtube' THEN 'v' || (page_id % 200) ELSE url END AS key FROM j),
json_rows AS (SELECT source, query, 'Entity' AS target, seq, position, key,
    CASE WHEN source = 'youtube' THEN CAST(l.n AS VARCHAR) WHEN source IN {tuple(_RANKED)} THEN CAST(position AS VARCHAR) END AS extra
  FROM j1 LEFT JOIN latest l ON source = 'youtube' AND l.video_id = key
  WHERE seq % 11 <> 5 AND (source NOT IN {tuple(_URL_NEEDED)} OR key <> '') AND (NOT ({sliced}) OR position <= {most})),
it AS (SELECT page_id, page_id // 10 AS seq, ({list(M.FEEDS)})[(page_id // 10) % 3 + 1] AS source, {_Q}[(page_id // 30) % 3 + 1] AS query,
    nullif({O.sql_strip('title_html')}, '') AS title, nullif(split_part(url, '?', 1), '') AS link,
    strftime(CAST(DATE '2024-01-01' + CAST((page_id * 37) % 400 AS INTEGER) AS DATE), '%a, %d %b %Y') || ' 08:00:00 GMT' AS pubDate,
    nullif({O.sql_strip("array_to_string(regexp_extract_all(body_html, '(?s)<p>(.*?)</p>', 1), ' ')")}, '') AS description FROM pp),
terms AS (SELECT *, list_transform(list_filter({O.sql_split('query')}, lambda w: length(w) > {_RSS_TERMS}), lambda w: lower(w)) AS terms,
    lower(concat_ws(' ', title, description)) AS hay FROM it WHERE source <> 'gnews_it'),
rel AS (SELECT * FROM terms WHERE (len(terms) = 0 OR len(list_filter(terms, lambda w: contains(hay, w))) > 0) AND coalesce(link, '') <> ''),
uniq AS (SELECT * FROM rel QUALIFY row_number() OVER (PARTITION BY source, query, link ORDER BY page_id) = 1),
top AS (SELECT *, row_number() OVER (PARTITION BY source, query ORDER BY coalesce(pubDate, '') DESC, page_id) AS position FROM uniq),
red AS (SELECT split_part(url, '?', 1) AS link, min(CASE WHEN page_id % 9 = 0 THEN 'https://consent.google.com/ml' WHEN page_id % 9 = 3 THEN ''
    ELSE 'https://resolved.example/' || page_id END) AS final_url FROM pages WHERE page_id % 3 = 0 GROUP BY ALL),
gn AS (SELECT it.*, row_number() OVER (PARTITION BY seq ORDER BY page_id) AS position,
    CASE WHEN coalesce(final_url, '') <> '' AND final_url NOT LIKE 'https://consent.google.com/%' THEN final_url ELSE it.link END AS to_link
  FROM it LEFT JOIN red ON red.link = it.link WHERE source = 'gnews_it'),
feed_rows AS (SELECT source, query, 'Entity' AS target, 0 AS seq, position, link AS key, pubDate AS extra FROM top WHERE position <= {most}
  UNION ALL SELECT source, query, 'Entity', seq, position, to_link, pubDate FROM gn WHERE position <= {most}),
{_TALK_CTES},
sec AS (SELECT k.*, doc_id // 3 AS ent, doc_id % 3 AS q, CASE WHEN doc_id % 2 = 1 THEN 'PAGE_' ELSE 'Page_' END || doc_id // 3 AS page
  FROM k WHERE doc_id % 17 <> 3 AND doc_id % 13 <> 5 AND kn <= {most}),
own AS (SELECT ent, lang, min(q) AS q FROM sec GROUP BY ALL),
talk_rows AS (SELECT 'wikitalk' AS source, {_Q}[sec.q + 1] AS query, 'Entity ' || sec.ent AS target, 0 AS seq, kn AS position,
    'https://' || sec.lang || '.wikipedia.org/wiki/Talk:' || page || '#Section_' || i AS key, CAST(length(clean) AS VARCHAR) AS extra
  FROM sec JOIN own ON own.ent = sec.ent AND own.lang = sec.lang AND own.q = sec.q),
vid AS (SELECT conv_id, conv_id % 3 AS q, conv_id // 12 AS ent, row_number() OVER (PARTITION BY conv_id % 3, conv_id // 12 ORDER BY conv_id) AS place,
    least(count(*) OVER (PARTITION BY conv_id % 3, conv_id // 12), {MAX_VIDEOS}) AS n FROM conversations WHERE turn = 0),
com AS (SELECT v.*, c.turn, length(c.text) AS replies, row_number() OVER (PARTITION BY c.conv_id ORDER BY c.turn) AS pos
  FROM vid v JOIN conversations c ON c.conv_id = v.conv_id AND c.turn > 0
  WHERE place <= {MAX_VIDEOS} AND v.conv_id % 11 <> 0 AND v.conv_id % 5 <> 4),
com1 AS (SELECT *, row_number() OVER (PARTITION BY q, ent ORDER BY place, pos) AS position FROM com WHERE pos <= greatest(1, {most} // n)),
comment_rows AS (SELECT 'youtube_comments' AS source, {_Q}[q + 1] AS query, 'Entity ' || ent AS target, 0 AS seq, position,
    'v' || conv_id || ':c' || turn AS key, CAST(replies AS VARCHAR) AS extra FROM com1 WHERE position <= {most}),
wp AS (SELECT page_id, page_id // 6 AS ent, (page_id // 2) % 3 AS q, page_id % 2 AS place, CASE WHEN page_id % 11 = 0 THEN NULL ELSE
    CASE WHEN page_id % 2 = 0 THEN 'it:t' ELSE 'en:t' END || (page_id * 7 + page_id // 2) % 2 END AS key, page_id % 5 <> 0 AS there FROM pages),
task AS (SELECT ent, q, max(key) FILTER (place = 0) AS k0, bool_or(there) FILTER (place = 0) AS e0, max(page_id) FILTER (place = 0) AS p0,
    max(key) FILTER (place = 1) AS k1, bool_or(there) FILTER (place = 1) AS e1, max(page_id) FILTER (place = 1) AS p1 FROM wp GROUP BY ALL),
seqscan AS (SELECT DISTINCT ent, -1::BIGINT AS q, []::VARCHAR[] AS taken, NULL::BIGINT AS page FROM task
  UNION ALL SELECT s.ent, t.q, CASE WHEN c = 0 THEN list_append(taken, k0) WHEN c = 1 THEN list_append(taken, k1) ELSE taken END,
    CASE WHEN c = 0 THEN p0 WHEN c = 1 THEN p1 END
  FROM seqscan s JOIN task t ON t.ent = s.ent AND t.q = (SELECT min(x.q) FROM task x WHERE x.ent = s.ent AND x.q > s.q),
    LATERAL (SELECT CASE WHEN k0 IS NOT NULL AND list_contains(taken, k0) THEN -1 WHEN k0 IS NOT NULL AND e0 THEN 0
      WHEN k1 IS NOT NULL AND list_contains(taken, k1) THEN -1 WHEN k1 IS NOT NULL AND e1 THEN 1 ELSE -1 END AS c)),
wiki_rows AS (SELECT 'wikipedia' AS source, {_Q}[wp.q + 1] AS query, 'Entity ' || wp.ent AS target, 0 AS seq, 1 AS position,
    wp.key AS key, url AS extra FROM seqscan s JOIN wp ON wp.page_id = s.page JOIN pages USING (page_id)),
every AS (SELECT * FROM json_rows UNION ALL SELECT * FROM feed_rows UNION ALL SELECT * FROM talk_rows
  UNION ALL SELECT * FROM comment_rows UNION ALL SELECT * FROM wiki_rows)
SELECT source, query, target, CAST({_TASK_SQL} AS BIGINT) AS task, CAST(seq AS BIGINT) AS seq, CAST(position AS BIGINT) AS position, key, extra FROM every"""


@query("landed_run", _run_sql(MAX_RESULTS))
def landed_run(spark, sf_dir):
    """Raw rows of a run over all 18 sources: JSON envelopes, statistics, feeds, talk pages, comments, encyclopedia."""
    return _shown(L.with_order(_scan(spark, sf_dir)[0], list(QUERIES)))


def _shown(raw):
    p, src = F.try_parse_json("payload"), F.col("source")

    def get(path):
        return F.try_variant_get(p, path, "string")

    plain = F.coalesce(*[get(r.url_path or "$.url") for r in {r.url_path: r for r in L.SCAN_RULES.values()}.values()])
    key = (F.when(src.isin(*M.FEEDS), get("$.link")).when(src == "wikitalk", get("$.url"))
           .when(src == "youtube_comments", F.concat(get("$.video_id"), F.lit(":"), get("$.comment.id")))
           .when(src == "wikipedia", F.concat(get("$.language"), F.lit(":"), F.lower(get("$.title")))).otherwise(plain))
    extra = (F.when(src.isin(*M.FEEDS), get("$.pubDate")).when(src == "wikitalk", F.length(get("$.wikitext")).cast("string"))
             .when(src == "youtube_comments", get("$.reply_count")).when(src == "wikipedia", get("$.url"))
             .when(src == "youtube", get("$.statistics.viewCount")).otherwise(get("$._rank")))
    return raw.select("source", "query", "target", F.col("ord.task").alias("task"), F.col("ord.seq").alias("seq"),
                      F.col("ord.pos").alias("position"), key.alias("key"), extra.alias("extra"))


@query("landed_dry_run", f"""SELECT * FROM ({_run_sql(1, dry=True)})
WHERE target = 'Entity' AND source NOT IN {tuple(sorted(P.OPT_IN_SOURCES))}""")
def landed_dry_run(spark, sf_dir):
    """Raw rows of a dry run of one target over the default sources: one result of every response or task."""
    params = P.RunParams(target="Entity", queries=QUERIES, dry_run=True, as_of=AS_OF, max_videos=MAX_VIDEOS)
    return _shown(scan_selected(_responses(spark, sf_dir), params, _redirects(spark, sf_dir))[0])


@query("landed_picked_sources", f"""SELECT * FROM ({_run_sql(MAX_RESULTS)})
WHERE target = 'Entity' AND source IN {PICKED} AND query IN {QUERIES[1:]}""".replace(
    _TASK_SQL, f"list_position({list(P.SOURCE_ORDER)}, source) * 2 - 3 + list_position({list(QUERIES[1:])}, query)"))
def landed_picked_sources(spark, sf_dir):
    """Raw rows of a run of one target and two queries over sources asked for by name, opt-in ones among them."""
    params = P.RunParams(target="Entity", queries=QUERIES[1:], sources=PICKED, max_results=MAX_RESULTS, as_of=AS_OF)
    return _shown(scan_selected(_responses(spark, sf_dir), params, _redirects(spark, sf_dir))[0])


@query("landed_run_rejects", f"""WITH r AS (
  SELECT ({list(JSON_SOURCES)})[seq % 12 + 1] AS source, {_Q}[seq % 3 + 1] AS query, 'Entity' AS target, 'invalid_response' AS reject_reason
  FROM (SELECT DISTINCT page_id // 10 AS seq FROM pages) WHERE seq % 11 = 5
  UNION ALL SELECT 'wikitalk', {_Q}[doc_id % 3 + 1], 'Entity ' || doc_id // 3, CASE WHEN doc_id % 17 = 3 THEN 'missing_sections' ELSE 'missing_wikitext' END
  FROM documents WHERE (doc_id % 17 = 3) <> (doc_id % 13 = 5)
  UNION ALL SELECT 'youtube_comments', {_Q}[conv_id % 3 + 1], 'Entity ' || conv_id // 12, 'error_response'
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE turn > 0) WHERE conv_id % 5 = 4)
SELECT source, query, target, reject_reason, count(*) AS responses FROM r GROUP BY ALL""")
def landed_run_rejects(spark, sf_dir):
    """What the run could not use: cut-off JSON, error responses, halves of talk pages."""
    bad = _scan(spark, sf_dir)[1]
    return bad.groupBy("source", "query", "target", "reject_reason").agg(F.count(F.lit(1)).alias("responses"))
