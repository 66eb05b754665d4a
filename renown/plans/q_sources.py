"""Landed-response scan queries (envelopes, ranks, caps, fallbacks, quotas, RSS, talk pages)."""

from __future__ import annotations

from pyspark.sql import functions as F

from renown import params as P
from renown.plans import oracle as O
from renown.plans.registry import query
from renown.sources import fixtures as X
from renown.sources import landed as L

_PP = r"""
pp AS (SELECT page_id, url, html,
              regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title_html,
              regexp_extract(html, '(?s)<body>(.*)</body>', 1) AS body_html,
              regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang FROM pages)"""


def _news_responses(spark, sf_dir):
    """One landed news response per 10 pages: {"articles": [...]} in page order."""
    pp = X.page_parts(spark, sf_dir)
    art = F.struct(F.col("page_id").alias("page_id"), F.col("title_html").alias("title"),
                   F.when(F.col("page_id") % 6 == 0, F.lit("")).otherwise(F.col("url")).alias("url"))
    grouped = pp.groupBy(F.floor(F.col("page_id") / 10).cast("bigint").alias("resp_id")).agg(
        F.array_sort(F.collect_list(art)).alias("articles"))
    return grouped.select("resp_id", F.lit("news").alias("source"),
                          F.to_json(F.struct("articles")).alias("response"))


@query("scan_ranked_cap", f"""WITH {_PP},
a AS (SELECT page_id // 10 AS resp_id, row_number() OVER (PARTITION BY page_id // 10 ORDER BY page_id) AS rank,
             CASE WHEN page_id % 6 = 0 THEN '' ELSE url END AS url, title_html AS title FROM pp)
SELECT resp_id, rank, url, title FROM a WHERE rank <= 5 AND url <> ''""")
def scan_ranked_cap(spark, sf_dir):
    items = L.explode_items(_news_responses(spark, sf_dir), "$.articles", cap=L.source_cap("news", 5),
                            keep_item="$.url")
    return items.select("resp_id", F.col("rank").cast("bigint").alias("rank"),
                        F.try_variant_get("item", "$.url", "string").alias("url"),
                        F.try_variant_get("item", "$.title", "string").alias("title"))


_SCAN_QUERIES = ("q0", "q1", "q2", "q3")
_SCANNED = f"""{_PP},
a AS (SELECT page_id // 10 AS seq, page_id, url,
             CASE (page_id // 10) % 3 WHEN 0 THEN 'news' WHEN 1 THEN 'nyt' ELSE 'reddit' END AS source,
             'q' || CAST((page_id // 10) % 4 AS VARCHAR) AS query,
             row_number() OVER (PARTITION BY page_id // 10 ORDER BY page_id) AS position
      FROM pp)"""


def _landed_responses(spark, sf_dir):
    """One landed response per 10 pages from three sources; some are cut off, some hold an error."""
    page = X.table(spark, sf_dir, "pages").select("page_id", F.floor(F.col("page_id") / 10).cast("bigint").alias("seq"),
                                                  F.when(F.col("page_id") % 6 == 0, "").otherwise(F.col("url")).alias("u"))
    r = page.groupBy("seq").agg(F.array_sort(F.collect_list(F.struct("page_id", "u"))).alias("p"))
    seq = F.col("seq")
    news = F.to_json(F.struct(F.when(seq % 7 == 3, "error").otherwise("ok").alias("status"),
                              F.transform("p", lambda e: F.struct(e["u"].alias("url"))).alias("articles")))
    nyt = F.to_json(F.struct(F.struct(F.transform("p", lambda e: F.struct(e["u"].alias("web_url"))).alias("docs"))
                             .alias("response")))
    reddit = F.to_json(F.struct(F.struct(F.transform("p", lambda e: F.struct(
        F.struct(e["u"].alias("permalink")).alias("data"))).alias("children")).alias("data")))
    body = F.when(seq % 3 == 0, news).when(seq % 3 == 1, nyt).otherwise(reddit)
    return r.select(
        F.when(seq % 3 == 0, "news").when(seq % 3 == 1, "nyt").otherwise("reddit").alias("source"),
        F.concat(F.lit("q"), (seq % 4).cast("string")).alias("query"), F.lit("Entity").alias("target"),
        F.lit(X.RETRIEVED_AT).alias("retrieved_at"), seq.alias("response_seq"),
        F.when(seq % 11 == 5, F.lit("{cut off")).otherwise(body).alias("response"))


@query("scan_landed", f"""WITH {_SCANNED}
SELECT source, query, seq, position, url,
       CASE WHEN source = 'nyt' THEN position END AS rank,
       list_position({list(P.SOURCE_ORDER)}, source) * 4 - 4 + CAST(query[2:] AS BIGINT) AS task
FROM a WHERE page_id % 6 <> 0 AND seq % 11 <> 5 AND NOT (source = 'news' AND seq % 7 = 3)
         AND (source <> 'nyt' OR position <= 5)""")
def scan_landed(spark, sf_dir):
    """Items of landed responses: all that news and reddit landed, five of each nyt response."""
    raw = L.with_order(L.scan_landed(_landed_responses(spark, sf_dir), 5), list(_SCAN_QUERIES))
    p = F.try_parse_json("payload")
    url = F.coalesce(*[F.try_variant_get(p, k, "string") for k in ("$.url", "$.web_url", "$.permalink")])
    return raw.select("source", "query", F.col("ord.seq").alias("seq"), F.col("ord.pos").alias("position"),
                      url.alias("url"), F.try_variant_get(p, "$._rank", "bigint").alias("rank"),
                      F.col("ord.task").alias("task"))


@query("rejected_responses", f"""WITH {_SCANNED}
SELECT DISTINCT source, query, CASE WHEN seq % 11 = 5 THEN 'invalid_response' ELSE 'error_response' END AS reject_reason,
       CAST(count(DISTINCT seq) AS BIGINT) AS responses
FROM a WHERE seq % 11 = 5 OR (source = 'news' AND seq % 7 = 3) GROUP BY ALL""")
def rejected_responses(spark, sf_dir):
    """Responses that were cut off or hold an error, counted per task."""
    bad = L.rejected_responses(_landed_responses(spark, sf_dir))
    return bad.groupBy("source", "query", "reject_reason").agg(F.count(F.lit(1)).alias("responses"))


@query("scan_fallback", f"""WITH {_PP},
a AS (SELECT 'q' || CAST(page_id % 50 AS VARCHAR) AS query, page_id, lang FROM pp),
pref AS (SELECT query, page_id FROM a WHERE lang = 'de')
SELECT query, page_id, false AS from_fallback FROM pref
UNION ALL
SELECT query, page_id, true AS from_fallback FROM a WHERE query NOT IN (SELECT query FROM pref)""")
def scan_fallback(spark, sf_dir):
    pp = X.page_parts(spark, sf_dir).withColumn(
        "lang", F.regexp_extract("html", r'<html lang="([^"]*)"', 1))
    a = pp.select(F.concat(F.lit("q"), (F.col("page_id") % 50).cast("string")).alias("query"), "page_id", "lang")
    pref = a.where(F.col("lang") == "de").select("query", "page_id", F.lit(False).alias("from_fallback"))
    fb = a.select("query", "page_id", F.lit(True).alias("from_fallback"))
    return L.with_fallback(pref, fb, ["query"])


@query("join_stats", """
WITH items AS (SELECT page_id, 'v' || CAST(page_id % 200 AS VARCHAR) AS video_id FROM pages),
stats AS (SELECT 'v' || CAST(user_id AS VARCHAR) AS video_id, CAST(count(*) AS BIGINT) AS view_count,
                 round(sum(value), 2) AS value_sum FROM events GROUP BY user_id)
SELECT i.page_id, i.video_id, s.view_count, s.value_sum FROM items i LEFT JOIN stats s ON s.video_id = i.video_id""")
def join_stats(spark, sf_dir):
    items = X.table(spark, sf_dir, "pages").select(
        "page_id", F.concat(F.lit("v"), (F.col("page_id") % 200).cast("string")).alias("video_id"))
    ev = X.table(spark, sf_dir, "events")
    stats = ev.groupBy(F.concat(F.lit("v"), F.col("user_id").cast("string")).alias("video_id")).agg(
        F.count(F.lit(1)).alias("view_count"), F.round(F.sum("value"), 2).alias("value_sum"))
    return L.join_statistics(items, stats).select("page_id", "video_id", "view_count", "value_sum")


_MAX_RESULTS, _MAX_VIDEOS = 20, 3


@query("comments_quota", f"""
WITH v AS (SELECT conv_id, 'q' || CAST(conv_id % 7 AS VARCHAR) AS query,
                  CASE WHEN conv_id % 11 = 0 THEN NULL ELSE 'v' || CAST(conv_id AS VARCHAR) END AS video_id,
                  row_number() OVER (PARTITION BY conv_id % 7 ORDER BY conv_id) AS video_rank
           FROM conversations WHERE turn = 0),
top AS (SELECT * FROM v WHERE video_rank <= {_MAX_VIDEOS}),
n AS (SELECT query, count(*) AS n_videos FROM top GROUP BY query),
c AS (SELECT t.query, t.video_rank, c.conv_id, c.turn,
             c.turn AS position,
             least(greatest(1, {_MAX_RESULTS} // n.n_videos), 100) AS quota
      FROM conversations c JOIN top t ON t.conv_id = c.conv_id JOIN n ON n.query = t.query
      WHERE c.turn > 0 AND t.video_id IS NOT NULL),
q AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY video_rank, position) AS rank
      FROM c WHERE position <= quota)
SELECT query, conv_id, turn, video_rank, position, rank FROM q WHERE rank <= {_MAX_RESULTS}""")
def comments_quota(spark, sf_dir):
    conv = X.table(spark, sf_dir, "conversations")
    from pyspark.sql import Window
    q = F.concat(F.lit("q"), (F.col("conv_id") % 7).cast("string"))
    v = conv.where(F.col("turn") == 0).select(
        "conv_id", q.alias("query"),
        F.when(F.col("conv_id") % 11 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("v"), F.col("conv_id").cast("string"))).alias("video_id"))
    v = v.withColumn("video_rank", F.row_number().over(Window.partitionBy("query").orderBy("conv_id")))
    # comment position = turn number (turns are 1.. per conversation): no window over a
    # possibly huge conversation
    c = conv.where(F.col("turn") > 0).withColumn("video_id", F.concat(F.lit("v"), F.col("conv_id").cast("string")))
    c = c.withColumn("position", F.col("turn"))
    out = L.comments_with_quota(v.drop("conv_id"), c.select("video_id", "conv_id", "turn", "position"),
                                _MAX_RESULTS, _MAX_VIDEOS, group=("query",))
    return out.select("query", "conv_id", "turn", F.col("video_rank").cast("bigint").alias("video_rank"),
                      "position", F.col("rank").cast("bigint").alias("rank"))


def _rss_feeds(spark, sf_dir):
    """Landed bbc feeds: one RSS document per 10 pages, items in page order."""
    pp = X.page_parts(spark, sf_dir)

    def esc(c):
        return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                         F.lit(">"), F.lit("&gt;"))

    day = F.date_add(F.lit("2024-01-01").cast("date"), ((F.col("page_id") * 37) % 400).cast("int"))
    item = F.concat(F.lit("<item><title>"), esc(F.col("title_html")), F.lit("</title><link>"),
                    esc(F.split("url", r"\?").getItem(0)), F.lit("</link><pubDate>"),
                    F.date_format(day, "EEE, dd MMM yyyy"), F.lit(" 08:00:00 GMT</pubDate><description>"),
                    esc(F.array_join(F.regexp_extract_all("body_html", F.lit(r"(?s)<p>(.*?)</p>"), 1), " ")),
                    F.lit("</description></item>"))
    feed_id = F.floor(F.col("page_id") / 10).cast("bigint")
    g = pp.groupBy(feed_id.alias("feed_id")).agg(
        F.array_sort(F.collect_list(F.struct("page_id", item.alias("x")))).alias("items"))
    qtext = (F.when(F.col("feed_id") % 3 == 0, F.lit("the war")).when(F.col("feed_id") % 3 == 1, F.lit("und der"))
             .otherwise(F.lit("xyzzy qq")))
    return g.select("feed_id", F.lit("bbc").alias("source"), qtext.alias("query"),
                    F.concat(F.lit("<rss version=\"2.0\"><channel><title>feed</title>"),
                             F.array_join(F.transform("items", lambda e: e["x"]), ""),
                             F.lit("</channel></rss>")).alias("response"))


@query("rss_topk", f"""WITH {_PP},
it AS (SELECT page_id AS ord, 'bbc' AS source,
              CASE (page_id // 10) % 3 WHEN 0 THEN 'the war' WHEN 1 THEN 'und der' ELSE 'xyzzy qq' END AS query,
              nullif({O.sql_strip('title_html')}, '') AS title, nullif(split_part(url, '?', 1), '') AS link,
              strftime(CAST(DATE '2024-01-01' + CAST((page_id * 37) % 400 AS INTEGER) AS DATE), '%a, %d %b %Y')
                || ' 08:00:00 GMT' AS pubDate,
              nullif({O.sql_strip("array_to_string(regexp_extract_all(body_html, '(?s)<p>(.*?)</p>', 1), ' ')")}, '') AS description
       FROM pp),
t AS (SELECT *, list_transform(list_filter({O.sql_split('query')}, lambda w: length(w) > 2), lambda w: lower(w)) AS terms,
             lower(concat_ws(' ', title, description)) AS hay FROM it),
rel AS (SELECT * FROM t WHERE (len(terms) = 0 OR len(list_filter(terms, lambda w: contains(hay, w))) > 0)
                          AND coalesce(link, '') <> ''),
f AS (SELECT source, query, link, min(ord) AS first_ord FROM rel GROUP BY source, query, link),
u AS (SELECT rel.* FROM rel JOIN f ON f.source = rel.source AND f.query = rel.query AND f.link = rel.link
                                  AND f.first_ord = rel.ord),
r AS (SELECT *, row_number() OVER (PARTITION BY source, query ORDER BY coalesce(pubDate, '') DESC, ord) AS rank FROM u)
SELECT query, ord, link, pubDate, rank FROM r WHERE rank <= 5""")
def rss_topk(spark, sf_dir):
    items = L.parse_rss(_rss_feeds(spark, sf_dir))
    items = items.withColumn("ord", F.col("feed_id") * 10 + F.col("item_pos"))
    top = L.rss_top_k(items, 5, 2, group=("source", "query"))
    return top.select("query", "ord", "link", "pubDate", F.col("rank").cast("bigint").alias("rank"))


@query("wikipedia_pick", f"""WITH {_PP},
a AS (SELECT 'Entity ' || CAST(page_id % 40 AS VARCHAR) AS target, page_id, lang,
             list_position(['fr', 'en'], lang) AS pref FROM pp),
b AS (SELECT target, min(pref) AS pref FROM a WHERE pref > 0 GROUP BY target),
c AS (SELECT a.* FROM a JOIN b ON a.target = b.target AND a.pref = b.pref),
d AS (SELECT target, min(page_id) AS page_id FROM c GROUP BY target)
SELECT c.target, c.page_id, c.lang FROM c JOIN d ON d.target = c.target AND d.page_id = c.page_id""")
def wikipedia_pick(spark, sf_dir):
    pp = X.page_parts(spark, sf_dir).select(
        F.concat(F.lit("Entity "), (F.col("page_id") % 40).cast("string")).alias("target"), "page_id",
        F.regexp_extract("html", r'<html lang="([^"]*)"', 1).alias("lang"))
    hit = L.first_language_hit(pp, ["fr", "en"])
    from renown.operators.dedup import first_per_key
    return first_per_key(hit, ["target"], "page_id").select("target", "page_id", "lang")


@query("resolve_links", """
WITH items AS (SELECT page_id, url AS link FROM pages),
red AS (SELECT url AS link,
               CASE WHEN page_id % 9 = 0 THEN 'https://consent.google.com/ml?continue=' || url
                    WHEN page_id % 9 = 3 THEN ''
                    ELSE 'https://resolved.example/a/' || CAST(page_id AS VARCHAR) END AS final_url
        FROM pages WHERE page_id % 3 = 0),
r AS (SELECT link, min(final_url) AS final_url FROM red GROUP BY link)
SELECT i.page_id, CASE WHEN r.final_url IS NOT NULL AND r.final_url <> ''
                         AND regexp_extract(r.final_url, '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?//([^/?#]*)', 1)
                             <> 'consent.google.com'
                       THEN r.final_url ELSE i.link END AS link
FROM items i LEFT JOIN r ON r.link = i.link""")
def resolve_links(spark, sf_dir):
    pages = X.table(spark, sf_dir, "pages")
    items = pages.select("page_id", F.col("url").alias("link"))
    k = F.col("page_id") % 9
    red = pages.where(F.col("page_id") % 3 == 0).select(
        F.col("url").alias("link"),
        F.when(k == 0, F.concat(F.lit("https://consent.google.com/ml?continue="), F.col("url")))
         .when(k == 3, F.lit(""))
         .otherwise(F.concat(F.lit("https://resolved.example/a/"), F.col("page_id").cast("string")))
         .alias("final_url"))
    return L.resolve_links(items, red).select("page_id", "link")


@query("saved_runs", """
WITH f AS (SELECT conv_id // 10 AS run, conv_id, turn, role, text,
                  row_number() OVER (PARTITION BY conv_id // 10 ORDER BY conv_id, turn) - 1 AS pos FROM conversations),
r AS (SELECT run, row_number() OVER (ORDER BY 'run=' || run || '/') AS file FROM (SELECT DISTINCT run FROM f))
SELECT f.role AS source, 'Entity ' || f.conv_id AS target, r.file AS file, f.pos AS position, f.text AS text
FROM f JOIN r ON r.run = f.run""")
def saved_runs(spark, sf_dir):
    """Saved runs (a JSON array file for ten conversations) read back: files by name, records by place."""
    from renown.session import scratch_path
    from renown.sources.sinks import read_saved_raw
    record = F.struct(F.col("role").alias("source"), F.lit("q").alias("query"),
                      F.concat(F.lit("Entity "), F.col("conv_id").cast("string")).alias("target"),
                      F.lit(X.RETRIEVED_AT).alias("retrieved_at"), F.struct("text").alias("payload"))
    runs = X.table(spark, sf_dir, "conversations").groupBy(F.expr("conv_id div 10").alias("run")).agg(
        F.array_sort(F.collect_list(F.struct("conv_id", "turn", record.alias("r")))).alias("rows"))
    path = scratch_path(spark, "saved-runs")
    runs.select("run", F.to_json(F.transform("rows", lambda e: e["r"])).alias("value")) \
        .repartition("run").write.partitionBy("run").text(path)
    raw = read_saved_raw(spark, path).drop("run")
    return raw.select("source", "target", F.shiftright("ord", 33).alias("file"),
                      F.col("ord").bitwiseAND(F.lit((1 << 33) - 1)).alias("position"),
                      F.try_variant_get(F.try_parse_json("payload"), "$.text", "string").alias("text"))
