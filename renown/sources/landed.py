"""Scans of landed API responses: envelope -> one raw row per item.

Live HTTP clients are out of scope; their row semantics are kept as scans
over responses landed in storage.  A landed response row carries
``source, query, target, retrieved_at, response`` (JSON or RSS text) plus
tags (instance, content type, site, feed, language).

All operators here are per-row array work (``slice`` / ``posexplode`` /
``filter``) or bounded top-k windows, so they need no shuffle unless a
cross-response rule (fallback, first-wins, top-k over feeds) asks for one.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from renown import params as P
from renown.functions.text import WS_CLASS, clean_wikitexts, keyword_relevant, py_strip
from renown.operators.dedup import first_per_key
from renown.session import materialize

# Envelope paths of the JSON responses (where the item array sits).
ENVELOPES: dict[str, str] = {
    "news": "$.articles", "gdelt": "$.articles", "youtube": "$.items", "stackexchange": "$.items",
    "guardian": "$.response.results", "nyt": "$.response.docs", "bluesky": "$.posts",
    "mastodon": "$.statuses", "hackernews": "$.hits", "brave": "$.web.results",
    "reddit": "$.data.children",
}
RSS_ITEM_SCHEMA = ("channel STRUCT<item: ARRAY<STRUCT<title: STRING, link: STRING, pubDate: STRING, "
                   "description: STRING, source: STRUCT<_VALUE: STRING, _url: STRING>>>>")


def source_cap(source: str, max_results: int) -> int:
    cap = P.SOURCE_CAPS.get(source)
    return max_results if cap is None else min(max_results, cap)


def explode_items(responses: DataFrame, path: str, cap: int | None = None,
                  keep_item: str | None = None, rank_before_filter: bool = True,
                  item_col: str = "item") -> DataFrame:
    """Explode the JSON item array at ``path`` into rows.

    ``cap`` slices the array first (the API-side limit), ``rank`` is the
    1-based position, counted before ``keep_item`` (a truthy-string path
    inside the item, e.g. ``$.url``) drops rows when ``rank_before_filter``;
    otherwise the rank is counted over the kept rows only.  Bad JSON or a
    non-array envelope gives no rows.
    """
    arr = F.try_variant_get(F.try_parse_json(F.col("response")), path, "array<variant>")
    if cap is not None:
        arr = F.slice(arr, 1, cap)
    cols = [c for c in responses.columns if c != "response"]
    out = responses.select(*cols, F.posexplode(arr).alias("_pos", item_col))
    if keep_item is not None:
        v = F.try_variant_get(F.col(item_col), keep_item, "string")
        if rank_before_filter:
            out = out.withColumn("rank", F.col("_pos") + 1).where(v.isNotNull() & (v != ""))
        else:
            out = out.where(v.isNotNull() & (v != "")).withColumn(
                "rank", F.row_number().over(Window.partitionBy(*cols).orderBy("_pos")))
    else:
        out = out.withColumn("rank", F.col("_pos") + 1)
    return out.drop("_pos")


def with_fallback(preferred: DataFrame, fallback: DataFrame, keys: list[str]) -> DataFrame:
    """Preferred rows, plus fallback rows for keys that have no preferred row.

    (e.g. a query whose language-filtered search was empty, a mastodon
    instance whose search gave nothing and whose hashtag timeline is used.)
    """
    have = materialize(preferred.select(*keys).distinct(), "fallback-keys")  # from files, so AQE may split a hot key
    return preferred.unionByName(fallback.join(have, keys, "left_anti"), allowMissingColumns=True)


def join_statistics(items: DataFrame, stats: DataFrame, key: str = "video_id") -> DataFrame:
    """Items left-joined to their statistics; a missing match keeps the item."""
    return items.join(stats, key, "left")


def comments_with_quota(videos: DataFrame, comments: DataFrame, max_results: int, max_videos: int = 3,
                        group: tuple[str, ...] = ("target", "query")) -> DataFrame:
    """Comments of the top videos of each query, per-video quota, total limit.

    ``videos``: (group..., video_rank, video_id [nullable], video_title);
    ``comments``: (video_id, position, ...).  The quota is
    ``max(1, max_results // n_videos)`` where ``n_videos`` counts the kept
    search results including those without an id.  Comments past
    ``max_results`` can't be within any quota and are left out before the
    join, so a video with many comments joins few of them.
    """
    g = list(group)
    top = videos.where(F.col("video_rank") <= max_videos)
    n = top.groupBy(*g).agg(F.count(F.lit(1)).alias("n_videos"))
    top = top.join(n, g)
    quota = F.greatest(F.lit(1), F.floor(F.lit(max_results) / F.col("n_videos")))
    c = comments.where(F.col("position") <= max_results)
    c = c.join(top.where(F.col("video_id").isNotNull()), "video_id").where(F.col("position") <= quota)
    w = Window.partitionBy(*g).orderBy("video_rank", "position")
    return c.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= max_results)


def parse_rss(feeds: DataFrame, doc_col: str = "response") -> DataFrame:
    """RSS documents -> one row per ``channel/item`` with trimmed text fields.

    A malformed document gives no rows; an empty element gives NULL.
    """
    parsed = F.from_xml(F.col(doc_col), RSS_ITEM_SCHEMA, {"mode": "PERMISSIVE"})
    cols = [c for c in feeds.columns if c != doc_col]
    out = feeds.select(*cols, F.posexplode(parsed["channel"]["item"]).alias("item_pos", "it"))

    def txt(name):
        v = py_strip(F.col(f"it.{name}"))
        return F.when(v != "", v)

    return out.select(*cols, "item_pos", txt("title").alias("title"), txt("link").alias("link"),
                      txt("pubDate").alias("pubDate"), txt("description").alias("description"),
                      txt("source._VALUE").alias("source_name"), txt("source._url").alias("source_url"))


def rss_top_k(items: DataFrame, k: int, min_term_len: int, group: tuple[str, ...] = ("target", "source", "query"),
              order_col: str = "ord") -> DataFrame:
    """bbc/ansa rule: relevance filter, first-wins by link, pubDate text desc, top k.

    The sort is on the pubDate *text* (the reference's order); ties keep
    feed order.  The top-k window is a ``row_number <= k`` which Spark
    turns into a per-partition group limit before the shuffle.
    """
    g = list(group)
    rel = items.where(keyword_relevant("query", "title", "description", min_term_len))
    rel = rel.where(F.coalesce(F.col("link"), F.lit("")) != "")
    uniq = first_per_key(rel, g + ["link"], order_col)
    w = Window.partitionBy(*g).orderBy(F.coalesce(F.col("pubDate"), F.lit("")).desc(), F.col(order_col))
    return uniq.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


# -- talk pages ---------------------------------------------------------------

# Header lines and template-only sections.
_HEADER_RE = rf"(?dm)^(={{2,}}){WS_CLASS}*(.+?){WS_CLASS}*\1{WS_CLASS}*$"
_TEMPLATE_ONLY_RE = r"(?s)^[\s]*\{\{[^}]+\}\}[\s]*$"


def talk_sections(pages: DataFrame, max_results: int,
                  min_len: int = P.MIN_TALK_SECTION_LENGTH) -> DataFrame:
    """Talk page -> one row per discussion section.

    ``pages``: (target, query, page_title, lang, wikitext, sections) where
    ``sections`` is the metadata array<struct<line, level, anchor, index>>.
    Body i is the text between header i and header i+1 (paired by
    position); sections whose cleaned text is shorter than ``min_len`` or
    that are a single template are dropped; the first ``max_results`` kept
    sections are returned.  Per-row array work only.
    """
    cols = [c for c in pages.columns if c not in ("wikitext", "sections")]
    metas = F.transform(F.col("sections"), lambda m, i: F.struct(m.alias("m"), i.alias("i")))
    bodies = F.slice(F.split(F.col("wikitext"), _HEADER_RE), 2, 1 << 30)   # split once a page

    paired = F.zip_with(metas, bodies, lambda s, body: F.when(s.isNotNull(), F.struct(
        s["m"].alias("m"), s["i"].alias("i"), py_strip(F.coalesce(body, F.lit(""))).alias("raw"))))
    pages = pages.withColumn("_raw", F.filter(paired, lambda e: e.isNotNull()))
    pages = pages.withColumn("_clean", clean_wikitexts(F.transform("_raw", lambda e: e["raw"])))
    secs = F.zip_with("_raw", "_clean", lambda e, t: F.struct(e["m"].alias("m"), e["i"].alias("i"), e["raw"].alias("raw"), t.alias("clean")))
    kept = F.filter(secs, lambda e: (F.length(e["clean"]) >= min_len) & ~e["raw"].rlike(_TEMPLATE_ONLY_RE))
    ex = pages.select(*cols, F.posexplode(F.slice(kept, 1, max_results)).alias("_n", "s"))
    title = F.coalesce(F.col("s.m.line"), F.lit(""))
    anchor = F.coalesce(F.col("s.m.anchor"), F.replace(title, F.lit(" "), F.lit("_")))
    base = F.concat(F.lit("https://"), F.col("lang"), F.lit(".wikipedia.org/wiki/Talk:"),
                    F.replace(F.col("page_title"), F.lit(" "), F.lit("_")))
    url = F.when(anchor != "", F.concat(base, F.lit("#"), anchor)).otherwise(base)
    return ex.select(
        *cols, title.alias("section_title"),
        F.coalesce(F.col("s.m.index"), F.col("s.i").cast("string")).alias("section_index"),
        F.coalesce(F.col("s.m.level"), F.lit(2)).alias("section_level"),
        F.col("s.clean").alias("wikitext"), url.alias("url"), (F.col("_n") + 1).alias("section_number"))


def first_language_hit(pages: DataFrame, lang_order: list[str], key: str = "target") -> DataFrame:
    """Wikipedia rule: per target take the page in the first preferred language."""
    pref = F.array_position(F.array(*[F.lit(x) for x in lang_order]), F.col("lang"))
    ranked = pages.where(pref > 0).withColumn("_pref", pref)
    best = ranked.groupBy(key).agg(F.min("_pref").alias("_pref"))
    return ranked.join(best, [key, "_pref"], "left_semi").drop("_pref")


# -- one call for all JSON sources --------------------------------------------

@dataclass(frozen=True)
class ScanRule:
    """How the landed JSON of a source becomes items.

    ``path`` is the item array and ``item_path`` the item inside an element;
    items without text at ``url_path`` are left out; ``rank_key`` names the
    payload key of the 1-based position; ``error_path`` holds something
    (``error_value``, if given) in an error response; ``sliced`` sources
    keep ``max_results`` items of a response (the others keep all that landed).
    """

    path: str
    item_path: str | None = None
    url_path: str | None = None
    rank_key: str | None = None
    error_path: str | None = None
    error_value: str | None = None
    sliced: bool = False


# The response shapes of the JSON sources.
SCAN_RULES: dict[str, ScanRule] = {
    "news": ScanRule("$.articles", url_path="$.url", error_path="$.status", error_value="error"),
    "gdelt": ScanRule("$.articles", url_path="$.url"),
    "youtube": ScanRule("$.items", url_path="$.id.videoId", rank_key="rank"),
    "guardian": ScanRule("$.response.results", rank_key="_rank"),
    "nyt": ScanRule("$.response.docs", url_path="$.web_url", rank_key="_rank", sliced=True),
    "bluesky": ScanRule("$.posts"),
    "stackexchange": ScanRule("$.items", error_path="$.error_id"),
    "mastodon": ScanRule("$.statuses"),
    "lemmy": ScanRule("$.posts"),
    "brave": ScanRule("$.web.results", url_path="$.url", rank_key="_rank"),
    "hackernews": ScanRule("$.hits"),
    "reddit": ScanRule("$.data.children", item_path="$.data", url_path="$.permalink"),
}
#: Tag columns of a response that its items carry in their payload.
TAGS = ("_instance", "_content_type", "_site", "_hashtag_fallback")
_TASK = ("source", "query", "target")


def register_scan(source: str, rule: ScanRule) -> None:
    """Add (or replace) the rule of a landed JSON source."""
    SCAN_RULES[source] = rule


def _per_source(rules: dict[str, ScanRule], value, default) -> Column:
    out = F.when(F.lit(False), default)
    for source, rule in rules.items():
        out = out.when(F.col("source") == source, value(source, rule))
    return out.otherwise(default)


def _with_items(responses: DataFrame) -> DataFrame:
    """Responses of the JSON sources with ``_items`` (NULL: none) and ``_fault`` (NULL: readable)."""
    v = F.col("_json")

    def items(source, rule):
        arr = F.try_variant_get(v, rule.path, "array<variant>")
        if source == "lemmy" and "_content_type" in responses.columns:
            comments = F.try_variant_get(v, "$.comments", "array<variant>")
            return F.when(F.col("_content_type") == "Comments", comments).otherwise(arr)
        if source == "mastodon" and "_hashtag_fallback" in responses.columns:
            timeline = F.try_variant_get(v, "$", "array<variant>")
            return F.when(F.col("_hashtag_fallback").isNotNull(), timeline).otherwise(arr)
        return arr

    def error(_source, rule):
        if rule.error_path is None:
            return F.lit(False)
        found = F.try_variant_get(v, rule.error_path, "string")
        return found.isNotNull() if rule.error_value is None else F.coalesce(found == rule.error_value, F.lit(False))

    df = responses.where(F.col("source").isin(*SCAN_RULES)).withColumn("_json", F.try_parse_json(F.col("response")))
    none = F.lit(None).cast("array<variant>")
    df = df.withColumn("_fault", F.when(v.isNull(), F.lit("invalid_response"))
                       .when(_per_source(SCAN_RULES, error, F.lit(False)), F.lit("error_response")))
    return df.withColumn("_items", F.when(F.col("_fault").isNull(), _per_source(SCAN_RULES, items, none))).drop("_json")


def _without_idle_fallbacks(df: DataFrame) -> DataFrame:
    """Leave out fallback responses of a task whose own search landed items.

    Fallbacks are mastodon hashtag timelines (``_hashtag_fallback``: the
    hashtag) and searches without language (``_any_language``: true).
    """
    marks = [F.col(c).isNotNull() for c in ("_hashtag_fallback",) if c in df.columns]
    marks += [F.coalesce(F.col(c), F.lit(False)) for c in ("_any_language",) if c in df.columns]
    if not marks:
        return df
    spare = reduce(Column.__or__, marks)
    keys = [*_TASK, *(["_instance"] if "_instance" in df.columns else [])]
    names = [f"_f{i}" for i in range(len(keys))]
    own = df.where(~spare & (F.size("_items") > 0)).select(
        *[F.coalesce(F.col(k), F.lit("")).alias(n) for k, n in zip(keys, names)]).distinct()
    own = materialize(own, "answered-tasks")  # from files, so AQE may split a hot task
    same = [F.coalesce(df[k], F.lit("")) == own[n] for k, n in zip(keys, names)]
    return df.join(own, reduce(Column.__and__, same, spare), "left_anti")


def scan_landed(responses: DataFrame, max_results: int, slice_all: bool = False) -> DataFrame:
    """Landed JSON responses of any source -> raw rows (one per item).

    ``responses``: (source, query, target, retrieved_at, response, [tags...]).
    The columns of ``TAGS`` are set in each item's payload, over a key of
    that name in the item.  What landed is kept whole but for sources that
    slice their results (``slice_all``, the dry run: every source does).
    The rank counts items before the url predicate.
    One pass: the item array is picked by a ``CASE source`` and exploded
    once, so the landing table is read once however it is partitioned.
    ``response_seq`` (order of responses within a task) and the tags are
    passed through for ``with_order``.  Unreadable and error responses give
    no rows here and are listed by ``rejected_responses``.  RSS feeds, talk
    pages, video comments and encyclopedia pages have their own scans
    (``sources.mixed``).
    """
    tags = [c for c in TAGS if c in responses.columns]
    df = _without_idle_fallbacks(_with_items(responses))
    sliced = [s for s, r in SCAN_RULES.items() if r.sliced or slice_all]
    items = F.when(F.col("source").isin(*sliced), F.slice("_items", 1, max_results)).otherwise(F.col("_items"))
    seq = ["response_seq"] if "response_seq" in responses.columns else []
    ex = df.select(*_TASK, "retrieved_at", *seq, *tags, F.posexplode(items).alias("_pos", "item"))
    item = _per_source({s: r for s, r in SCAN_RULES.items() if r.item_path},
                       lambda _, r: F.try_variant_get(F.col("item"), r.item_path, "variant"), F.col("item"))
    ex = ex.withColumn("item", item).withColumn("position", F.col("_pos") + 1)

    def has_url(_source, rule):
        return F.coalesce(F.try_variant_get(F.col("item"), rule.url_path, "string") != "", F.lit(False))

    ex = ex.where(_per_source({s: r for s, r in SCAN_RULES.items() if r.url_path}, has_url, F.lit(True)))
    ranks = [F.when(F.col("source").isin(*[s for s, r in SCAN_RULES.items() if r.rank_key == key]),
                    F.col("position")).alias(key)
             for key in sorted({r.rank_key for r in SCAN_RULES.values() if r.rank_key})]
    as_map = "map<string,variant>"
    extra = F.try_variant_get(F.parse_json(F.to_json(F.struct(*tags, *ranks))), "$", as_map)
    ex = ex.withColumn("_extra", extra).withColumn("_object", F.try_variant_get("item", "$", as_map))
    own = F.map_filter("_object", lambda k, _: ~F.map_contains_key(F.col("_extra"), k))
    body = F.when(F.col("_object").isNull() | (F.size("_extra") == 0), F.to_json("item")) \
            .otherwise(F.to_json(F.map_concat(own, F.col("_extra")), {"ignoreNullFields": "false"}))
    return ex.select(*_TASK, "retrieved_at", *seq, *tags, body.alias("payload"), "position")


def rejected_responses(responses: DataFrame) -> DataFrame:
    """Responses that can't be scanned: (source, query, target, retrieved_at, payload, reject_reason)."""
    return _with_items(responses).where(F.col("_fault").isNotNull()).select(
        *_TASK, "retrieved_at", F.col("response").alias("payload"), F.col("_fault").alias("reject_reason"))


# -- redirects and task order ---------------------------------------------------

CONSENT_HOST = "consent.google.com"


def resolve_links(items: DataFrame, redirects: DataFrame, link_col: str = "link") -> DataFrame:
    """Replace each link by its landed resolution (link -> final_url).

    Left join: items without a resolution keep their link; a resolution
    whose host is exactly the consent gate, or that is empty, is ignored.
    One resolution per link (the smallest, for determinism).
    """
    from renown.functions.urls import to_domain
    r = redirects.where(F.col("link").isNotNull()).groupBy(F.col("link").alias("_rl")) \
                 .agg(F.min("final_url").alias("_rf"))
    r = materialize(r, "resolved-links")  # from files, so AQE may split a hot link
    j = items.join(r, items[link_col] == r["_rl"], "left")
    use = F.col("_rf").isNotNull() & (F.col("_rf") != "") & (to_domain(F.col("_rf")) != CONSENT_HOST)
    return j.withColumn(link_col, F.when(use, F.col("_rf")).otherwise(F.col(link_col))).drop("_rl", "_rf")


def task_index(queries: list[str], sources: tuple[str, ...] = P.SOURCE_ORDER) -> Column:
    """Fan-out order of a (source, query) task: source-major, then query (0-based).

    Computed from literal parameter arrays; no join and no cross product.
    """
    si = F.array_position(F.array(*[F.lit(s) for s in sources]), F.col("source")) - 1
    qi = F.array_position(F.array(*[F.lit(q) for q in queries]), F.col("query")) - 1
    return si * F.lit(len(queries)) + qi


def with_order(raw: DataFrame, queries: list[str], response_seq: str = "response_seq",
               position: str = "position", sources: tuple[str, ...] = P.SOURCE_ORDER) -> DataFrame:
    """Deterministic ``ord``: struct of task index, response sequence, tags and position.

    This is the order first-wins dedup and the distribution ties follow;
    ``monotonically_increasing_id`` would depend on partitioning.  The tags
    tell responses of a task apart that have no sequence number.  A row of
    an unknown source or query fails the job.
    """
    t = task_index(queries, sources)
    seq = F.coalesce(F.col(response_seq), F.lit(0)) if response_seq in raw.columns else F.lit(0)
    tags = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in TAGS if c in raw.columns]
    task = F.when(t >= 0, t).otherwise(F.raise_error(F.lit("ord: unknown source or query")))
    return raw.withColumn("ord", F.struct(task.cast("bigint").alias("task"), seq.cast("bigint").alias("seq"), *tags,
                                          F.col(position).cast("bigint").alias("pos")))


def require_distinct_responses(responses: DataFrame) -> None:
    """Raise if two responses of a task can't be told apart by sequence number and tags.

    Reads no response texts; one count per response is grouped.
    """
    keys = [c for c in (*_TASK, "response_seq", *TAGS, "_kind", "_language", "_page", "_video_id") if c in responses.columns]
    twice = responses.groupBy(*keys).count().where("count > 1").take(1)
    if twice:
        raise ValueError(f"responses without distinct response_seq or tags: {twice[0].asDict()}")
