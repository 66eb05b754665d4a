"""Normalisation: landed raw rows (JSON payload) -> the fixed record schema.

Raw schema: ``ord, source, query, target, retrieved_at, payload`` where
``payload`` is JSON text.  It is parsed once into a VARIANT and read with
``try_variant_get`` (type drift gives NULL instead of failing).

One ``select`` with a ``CASE source`` per output field covers every
source: the raw table is scanned once (no per-source filter + union, which
would rescan it 19 times).  Entity decoding -- the only Python step -- is
applied once per field to whatever needs it, not once per source.

Rows that cannot become records are kept with a ``reject_reason``
(``accepted``/``rejects`` split them); nothing is silently lost.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renown.functions.dates import epoch_to_date, to_date
from renown.functions.text import (HTML_TAG_RE, _LINE_BREAK, extract_topic, first_non_empty,
                                   html_unescape, language_code, py_strip)
from renown.functions.urls import to_domain, to_url

# Fixed values
HN_ITEM_BASE = "https://news.ycombinator.com/item?id="
REDDIT_BASE = "https://www.reddit.com"
REDDIT_REMOVED = ("[removed]", "[deleted]", "")
BRAVE_MERGE_BELOW = 80
FALLBACK_TITLE_KEYS = ("title", "headline", "name", "subject", "webTitle")
FALLBACK_TEXT_KEYS = ("text", "body", "content", "description", "trailText", "selftext")
FALLBACK_URL_KEYS = ("url", "link", "webUrl", "ap_id", "uri", "shortUrl")
FALLBACK_DATE_KEYS = ("date", "published", "published_at", "webPublicationDate",
                      "pubDate", "created_at", "createdUtc")

FIELDS = ("title", "text", "date", "url", "author", "language", "domain",
          "views_count", "likes_count", "comments_count")

_SEP = "\u0000"
P_COL = "_p"


def j(path: str, typ: str = "string") -> Column:
    return F.try_variant_get(F.col(P_COL), path, typ)


def jnull(path: str) -> Column:
    """The key is present and holds JSON null (``p.get(k, {})`` would fail)."""
    return F.coalesce(F.is_variant_null(F.try_variant_get(F.col(P_COL), path, "variant")), F.lit(False))


def truthy(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def _or(a: Column, b: Column) -> Column:
    """Python ``a or b`` for strings."""
    return F.when(truthy(a), a).otherwise(b)


def _int(path: str) -> Column:
    return j(path, "bigint")


def _tagless(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), HTML_TAG_RE, "")


def _mastodon_pre(c: Column) -> Column:
    t = F.coalesce(c, F.lit(""))
    t = F.regexp_replace(t, r"<br\s*/?>", "\n")
    t = F.regexp_replace(t, r"</p>\s*<p>", "\n\n")
    return F.regexp_replace(t, HTML_TAG_RE, "")


class Spec:
    """Field expressions of one source, over payload paths only.

    Stage 1 (per source, small expressions): ``fields`` may hold
    ``title``, ``text``, ``author``, ``language``, counts, ``date_txt``
    (text for ``to_date``), ``date_epoch`` (seconds), ``url_raw`` (text for
    ``to_url``), ``url_direct`` (final url, bypasses ``to_url``).
    ``html_title``/``html_text`` are tag-stripped pre-images decoded once
    for all sources; ``post_title``/``post_text`` finish the decoded value.
    Stage 2: ``domain`` is a function of the final ``url`` column.
    ``malformed`` flags rows the reference would fail on.
    """

    def __init__(self, fields: dict[str, Column], domain: Callable[[Column], Column] | None = None,
                 html_title: Column | None = None, html_text: Column | None = None,
                 post_title: Callable[[Column], Column] | None = None,
                 post_text: Callable[[Column], Column] | None = None,
                 malformed: Column | None = None):
        self.fields = fields
        self.domain = domain or (lambda url: to_domain(url))
        self.html_title = html_title
        self.html_text = html_text
        self.post_title = post_title
        self.post_text = post_text
        self.malformed = malformed


def _ns() -> Column:
    return F.lit(None).cast("string")


def _rss(language: Column) -> Spec:
    return Spec({"title": first_non_empty(j("$.title")), "date_txt": j("$.pubDate"), "url_raw": j("$.link"),
                 "author": _ns(), "language": language},
                html_text=_tagless(j("$.description")))


def _bluesky() -> Spec:
    uri = F.coalesce(j("$.uri"), F.lit(""))
    handle = F.coalesce(j("$.author.handle"), F.lit(""))
    rkey = F.regexp_extract(uri, r"([^/]*)$", 1)
    url = F.when(truthy(handle) & truthy(rkey),
                 F.concat(F.lit("https://bsky.app/profile/"), handle, F.lit("/post/"), rkey))
    return Spec({"title": F.lit(""), "text": first_non_empty(j("$.record.text")),
                 "date_txt": _or(j("$.record.createdAt"), j("$.indexedAt")), "url_raw": url,
                 "author": first_non_empty(j("$.author.displayName"), j("$.author.handle")),
                 "language": _ns(), "likes_count": _int("$.likeCount"), "comments_count": _int("$.replyCount")},
                domain=lambda u: F.lit("bsky.app"),
                malformed=jnull("$.record") | jnull("$.author"))


def _brave() -> Spec:
    lang = j("$.language")
    host = j("$.meta_url.hostname")
    snippets = j("$.extra_snippets", "array<string>")
    joined = F.concat_ws(_SEP, _tagless(j("$.description")),
                         F.array_join(F.transform(F.coalesce(snippets, F.array().cast("array<string>")),
                                                  lambda s: _tagless(s)), _SEP))

    def post(dec: Column) -> Column:
        parts = F.transform(F.split(dec, _SEP), lambda s: py_strip(s))
        desc = F.element_at(parts, 1)
        merged = F.array_join(F.filter(parts, lambda s: s != ""), " ")
        return F.when((F.length(desc) >= BRAVE_MERGE_BELOW) | snippets.isNull() | (F.size(snippets) == 0), desc) \
                .otherwise(merged)

    return Spec({"date_txt": j("$.page_age"), "url_raw": j("$.url"), "author": _ns(),
                 "language": F.when(truthy(py_strip(lang)), F.lower(lang)), "_host": host},
                domain=lambda u: _or(host, to_domain(u)),
                html_title=_tagless(first_non_empty(j("$.title"))), html_text=joined, post_text=post)


def _gdelt() -> Spec:
    dom_raw = first_non_empty(j("$.domain"))
    return Spec({"title": first_non_empty(j("$.title")), "text": F.lit(""), "date_txt": j("$.seendate"),
                 "url_raw": j("$.url"), "author": _ns(), "language": language_code(j("$.language"))},
                domain=lambda u: _or(to_domain(u), dom_raw))


def _gnews() -> Spec:
    src = j("$.source_url")
    return Spec({"title": first_non_empty(j("$.title")), "date_txt": j("$.pubDate"), "url_raw": j("$.link"),
                 "author": j("$.source_name"), "language": F.lit("it")},
                domain=lambda u: F.when(truthy(src), to_domain(src)).otherwise(to_domain(u)),
                html_text=_tagless(j("$.description")))


def _guardian() -> Spec:
    return Spec({"title": first_non_empty(j("$.fields.headline"), j("$.webTitle")),
                 "text": first_non_empty(j("$.fields.bodyText"), j("$.fields.trailText")),
                 "date_txt": j("$.webPublicationDate"), "url_raw": _or(j("$.fields.shortUrl"), j("$.webUrl")),
                 "author": first_non_empty(j("$.fields.byline")), "language": _ns()},
                domain=lambda u: _or(to_domain(u), F.lit("theguardian.com")),
                malformed=jnull("$.fields"))


def _hackernews() -> Spec:
    raw_url = j("$.url")
    return Spec({"title": first_non_empty(j("$.title")), "date_txt": j("$.created_at"),
                 "url_raw": F.when(truthy(raw_url), raw_url),
                 "url_direct": F.when(~truthy(raw_url),
                                      F.concat(F.lit(HN_ITEM_BASE), F.coalesce(j("$.objectID"), F.lit("")))),
                 "author": j("$.author"), "language": _ns(),
                 "likes_count": _int("$.points"), "comments_count": _int("$.num_comments")},
                html_text=_tagless(j("$.story_text")))


def _lemmy() -> Spec:
    is_comment = F.coalesce(j("$._content_type"), F.lit("Posts")) == "Comments"
    post_name = F.coalesce(j("$.post.name"), F.lit(""))
    body = F.coalesce(j("$.post.body"), F.lit(""))
    title = F.when(is_comment, F.when(truthy(post_name), F.concat(F.lit("[Comment] "), post_name))
                   .otherwise(F.lit(""))).otherwise(post_name)
    text = F.when(is_comment, F.coalesce(j("$.comment.content"), F.lit(""))) \
            .otherwise(F.when(truthy(body), body).otherwise(post_name))
    instance = F.coalesce(j("$._instance"), F.lit("lemmy.world"))
    return Spec({"title": title, "text": text,
                 "date_txt": F.when(is_comment, j("$.comment.published")).otherwise(j("$.post.published")),
                 "url_raw": F.when(is_comment, j("$.comment.ap_id")).otherwise(j("$.post.ap_id")),
                 "author": first_non_empty(j("$.creator.name")), "language": _ns(),
                 "likes_count": _int("$.counts.score"),
                 "comments_count": F.when(is_comment, _int("$.counts.child_count")).otherwise(_int("$.counts.comments"))},
                domain=lambda u: instance,
                malformed=jnull("$.creator") | jnull("$.counts")
                | (is_comment & (jnull("$.comment") | jnull("$.post"))) | (~is_comment & jnull("$.post")))


def _mastodon() -> Spec:
    spoiler = j("$.spoiler_text")
    instance = F.coalesce(j("$._instance"), F.lit("mastodon.social"))

    def post(dec: Column) -> Column:
        lines = F.transform(F.split(dec, _LINE_BREAK), lambda ln: py_strip(ln))
        return py_strip(F.array_join(F.filter(lines, lambda ln: ln != ""), "\n"))

    return Spec({"title": F.when(truthy(spoiler), py_strip(spoiler)).otherwise(F.lit("")),
                 "date_txt": j("$.created_at"), "url_raw": _or(j("$.url"), j("$.uri")),
                 "author": first_non_empty(j("$.account.display_name"), j("$.account.acct")),
                 "language": j("$.language"),
                 "likes_count": _int("$.favourites_count"), "comments_count": _int("$.replies_count"),
                 "views_count": _int("$.reblogs_count")},
                domain=lambda u: instance,
                html_text=_mastodon_pre(j("$.content")), post_text=post, malformed=jnull("$.account"))


def _news() -> Spec:
    src_name = first_non_empty(j("$.source.name"))
    return Spec({"title": first_non_empty(j("$.title")),
                 "text": first_non_empty(j("$.description"), j("$.content")),
                 "date_txt": j("$.publishedAt"), "url_raw": j("$.url"), "author": first_non_empty(j("$.author")),
                 "language": first_non_empty(j("$.language"))},
                domain=lambda u: _or(to_domain(u), src_name))


def _nyt() -> Spec:
    byline = F.coalesce(j("$.byline.original"), F.lit(""))
    author = py_strip(F.when(F.startswith(byline, F.lit("By ")), F.substring(byline, 4, 1 << 30)).otherwise(byline))
    return Spec({"title": first_non_empty(j("$.headline.main")),
                 "text": first_non_empty(j("$.abstract"), j("$.lead_paragraph")),
                 "date_txt": j("$.pub_date"), "url_raw": j("$.web_url"), "author": first_non_empty(author),
                 "language": _ns()},
                domain=lambda u: _or(to_domain(u), F.lit("nytimes.com")))


def _reddit() -> Spec:
    permalink = j("$.permalink")
    selftext = py_strip(F.coalesce(j("$.selftext"), F.lit("")))
    author, sub = j("$.author"), j("$.subreddit")
    return Spec({"title": first_non_empty(j("$.title")), "date_epoch": j("$.created_utc", "double"),
                 "url_raw": F.when(truthy(permalink), F.concat(F.lit(REDDIT_BASE), permalink)),
                 "author": F.when(truthy(author) & truthy(sub), F.concat(author, F.lit(" [r/"), sub, F.lit("]")))
                            .when(truthy(author), author),
                 "language": _ns(), "likes_count": _int("$.score"), "comments_count": _int("$.num_comments")},
                html_text=F.when(~selftext.isin(*REDDIT_REMOVED), _tagless(selftext)).otherwise(F.lit("")))


def _stackexchange() -> Spec:
    site = F.coalesce(j("$._site"), F.lit("stackoverflow"))
    is_answer = F.coalesce(j("$.item_type"), F.lit("question")) == "answer"
    aid, qid = j("$.answer_id"), j("$.question_id")
    base = F.concat(F.lit("https://"), site, F.lit(".com"))
    raw_url = (F.when(is_answer & truthy(aid) & (aid != "0"), F.concat(base, F.lit("/a/"), aid))
                .when(truthy(qid) & (qid != "0"), F.concat(base, F.lit("/questions/"), qid)))
    return Spec({"date_epoch": j("$.creation_date", "double"), "url_raw": raw_url,
                 "author": first_non_empty(j("$.owner.display_name")), "language": _ns(),
                 "likes_count": _int("$.score")},
                domain=lambda u: F.concat(site, F.lit(".com")),
                html_title=_tagless(j("$.title")), html_text=_tagless(j("$.excerpt")),
                post_title=lambda t: F.when(is_answer & (t != ""), F.concat(F.lit("[Answer] "), t)).otherwise(t),
                malformed=jnull("$.owner"))


def _wikipedia() -> Spec:
    return Spec({"title": first_non_empty(j("$.title")), "text": first_non_empty(j("$.summary"), j("$.text")),
                 "url_raw": j("$.url"), "author": _ns(), "language": first_non_empty(j("$.language"))},
                domain=lambda u: F.lit("wikipedia.org"))


def _wikitalk() -> Spec:
    page = F.coalesce(j("$.page_title"), F.lit(""))
    section = j("$.section_title")
    lang = F.coalesce(j("$.language"), F.lit("en"))
    title = F.when(truthy(section), F.concat(F.lit("[Talk] "), page, F.lit(": "), section)) \
             .otherwise(F.concat(F.lit("[Talk] "), page))
    return Spec({"title": title, "text": F.coalesce(j("$.wikitext"), F.lit("")),
                 "url_raw": j("$.url"), "author": _ns(), "language": lang},
                domain=lambda u: F.concat(lang, F.lit(".wikipedia.org")))


def _youtube() -> Spec:
    vid = j("$.id.videoId")
    return Spec({"title": first_non_empty(j("$.snippet.title")), "text": first_non_empty(j("$.snippet.description")),
                 "date_txt": j("$.snippet.publishedAt"),
                 "url_raw": F.when(truthy(vid), F.concat(F.lit("https://www.youtube.com/watch?v="), vid)),
                 "author": first_non_empty(j("$.snippet.channelTitle")), "language": _ns(),
                 "views_count": _int("$.statistics.viewCount"),
                 "likes_count": _int("$.statistics.likeCount"), "comments_count": _int("$.statistics.commentCount")},
                domain=lambda u: F.lit("youtube.com"),
                malformed=jnull("$.snippet") | jnull("$.statistics"))


def _youtube_comments() -> Spec:
    vid, cid = j("$.video_id"), j("$.comment.id")
    return Spec({"title": first_non_empty(j("$.video_title")), "text": first_non_empty(j("$.comment.snippet.textDisplay")),
                 "date_txt": j("$.comment.snippet.publishedAt"),
                 "url_raw": F.when(truthy(vid) & truthy(cid),
                                   F.concat(F.lit("https://www.youtube.com/watch?v="), vid, F.lit("&lc="), cid)),
                 "author": first_non_empty(j("$.comment.snippet.authorDisplayName")), "language": _ns(),
                 "likes_count": _int("$.comment.snippet.likeCount"), "comments_count": _int("$.reply_count")},
                domain=lambda u: F.lit("youtube.com"),
                malformed=jnull("$.comment") | jnull("$.comment.snippet"))


def _fallback() -> Spec:
    def fne(keys):
        return first_non_empty(*[j(f"$.{k}") for k in keys])

    date_txt = fne(FALLBACK_DATE_KEYS)
    return Spec({"title": fne(FALLBACK_TITLE_KEYS), "text": fne(FALLBACK_TEXT_KEYS),
                 "date_txt": F.when(date_txt != "", date_txt), "url_raw": fne(FALLBACK_URL_KEYS),
                 "author": first_non_empty(j("$.author"), j("$.byline"), j("$.creator")), "language": _ns()})


_BUILTIN: dict[str, Callable[[], Spec]] = {
    "ansa": lambda: _rss(F.lit("it")),
    "bbc": lambda: _rss(_ns()),
    "bluesky": _bluesky,
    "brave": _brave,
    "gdelt": _gdelt,
    "gnews_it": _gnews,
    "guardian": _guardian,
    "hackernews": _hackernews,
    "lemmy": _lemmy,
    "mastodon": _mastodon,
    "news": _news,
    "nyt": _nyt,
    "reddit": _reddit,
    "stackexchange": _stackexchange,
    "wikipedia": _wikipedia,
    "wikitalk": _wikitalk,
    "youtube": _youtube,
    "youtube_comments": _youtube_comments,
}
_REGISTRY: dict[str, Callable[[], Spec]] = dict(_BUILTIN)


_GENERATION = [0]
_EXPR_CACHE: dict = {}


def register_source(name: str, spec_fn: Callable[[], Spec]) -> None:
    """Add or replace a source's normaliser; the last registration wins."""
    _REGISTRY[name] = spec_fn
    _GENERATION[0] += 1


def registered_sources() -> list[str]:
    return list(_REGISTRY)


def _dispatch(specs: dict[str, Spec], fb: Spec, pick: Callable[[Spec], Column | None],
              default: Column) -> Column:
    src = F.col("source")
    expr = None
    for name, spec in specs.items():
        v = pick(spec)
        if v is None:
            continue
        expr = F.when(src == name, v) if expr is None else expr.when(src == name, v)
    fv = pick(fb)
    fv = default if fv is None else fv
    return fv if expr is None else expr.otherwise(fv)


_TYPES = {"date": "date", "views_count": "bigint", "likes_count": "bigint", "comments_count": "bigint",
          "date_epoch": "double"}
_STAGE1 = ("title", "text", "author", "language", "views_count", "likes_count", "comments_count",
           "date_txt", "date_epoch", "url_raw", "url_direct")


def _fence(c: Column) -> Column:
    """Return ``c`` unchanged, but stop filters on it from being pushed below.

    A predicate on ``reject_reason`` would otherwise be pushed down through
    the projections and the parse, with every per-source CASE (and the JSON
    parse they read) copied into the predicate: the payload would be parsed
    several times per row and the plan grows by orders of magnitude.
    Predicate pushdown does not cross a projection holding a
    nondeterministic expression; ``spark_partition_id() >= 0`` is always
    true (``rand() >= 0`` would be folded away by the optimizer).
    """
    return F.when(F.spark_partition_id() >= 0, c)


def _stages() -> tuple[dict, dict, dict]:
    """Column expressions of the three projection stages.

    They only name columns, so they are built once per Spark context and
    registry state (building them costs thousands of py4j calls).
    """
    from pyspark import SparkContext
    key = (id(SparkContext._active_spark_context), _GENERATION[0])
    hit = _EXPR_CACHE.get(key)
    if hit is not None:
        return hit
    specs = {n: fn() for n, fn in _REGISTRY.items()}
    fb = _fallback()

    # stage 1: per-source picks over payload paths (small expressions)
    s1 = {}
    for f in _STAGE1:
        typ = _TYPES.get(f, "string")
        s1[f"_{f}"] = _dispatch(specs, fb, lambda s, f=f: s.fields.get(f), F.lit(None).cast(typ)).cast(typ)
    s1["_pt"] = _dispatch(specs, fb, lambda s: s.html_title, _ns())
    s1["_px"] = _dispatch(specs, fb, lambda s: s.html_text, _ns())
    s1["_bad"] = _dispatch(specs, fb, lambda s: s.malformed, F.lit(False))
    s1["_ok"] = F.col(P_COL).isNotNull() & F.startswith(F.ltrim(F.col("payload")), F.lit("{"))

    # stage 2: shared conversions, each applied once
    s2 = {
        "url": F.coalesce(F.col("_url_direct"), to_url(F.col("_url_raw"))),
        "date": F.coalesce(to_date(F.col("_date_txt")), epoch_to_date(F.col("_date_epoch"))),
        "_dt": html_unescape(F.col("_pt")),
        "_dx": html_unescape(F.col("_px")),
    }

    # stage 3: finish decoded text and the url-dependent domain
    def pick_title(s):
        if s.html_title is None:
            return F.col("_title")
        t = py_strip(F.col("_dt"))
        return s.post_title(t) if s.post_title else t

    def pick_text(s):
        if s.html_text is None:
            return F.col("_text")
        return s.post_text(F.col("_dx")) if s.post_text else py_strip(F.col("_dx"))

    s3 = {
        "title": _dispatch(specs, fb, pick_title, _ns()),
        "text": _dispatch(specs, fb, pick_text, _ns()),
        "domain": _dispatch(specs, fb, lambda s: s.domain(F.col("url")), _ns()),
        "author": F.col("_author"), "language": F.col("_language"),
        "views_count": F.col("_views_count"), "likes_count": F.col("_likes_count"),
        "comments_count": F.col("_comments_count"),
        "reject_reason": _fence(F.when(~F.col("_ok"), F.lit("invalid_payload"))
                                .when(F.coalesce(F.col("source"), F.lit("")) == "", F.lit("missing_source"))
                                .when(F.coalesce(F.col("target"), F.lit("")) == "", F.lit("missing_target"))
                                .when(F.col("_bad"), F.lit("malformed_payload"))
                                .when(F.coalesce(F.col("url"), F.lit("")) == "", F.lit("missing_url"))),
        "topic": extract_topic("target", "query"),
    }
    _EXPR_CACHE.clear()
    _EXPR_CACHE[key] = (s1, s2, s3)
    return s1, s2, s3


def normalize(raw: DataFrame) -> DataFrame:
    """Raw rows -> records with ``reject_reason`` (NULL for accepted rows)."""
    s1, s2, s3 = _stages()
    df = raw.withColumn(P_COL, F.try_parse_json(F.col("payload")))
    df = df.withColumns(s1).withColumns(s2).withColumns(s3)
    return df.drop(P_COL, "_pt", "_px", "_dt", "_dx", "_bad", "_ok", *[f"_{f}" for f in _STAGE1])


RECORD_COLUMNS = ("ord", "source", "query", "topic", "target", "title", "text", "date", "url", "author",
                  "language", "domain", "retrieved_at", "views_count", "likes_count", "comments_count")


def accepted(normalized: DataFrame) -> DataFrame:
    return normalized.where(F.col("reject_reason").isNull()).select(*RECORD_COLUMNS)


def rejects(normalized: DataFrame) -> DataFrame:
    return normalized.where(F.col("reject_reason").isNotNull()).select(
        "ord", "source", "query", "target", "reject_reason", "payload")
