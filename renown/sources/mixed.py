"""Landed runs over every source: JSON, feeds, talk pages, comments, encyclopedia pages, statistics.

``scan_run`` turns the responses of a run into raw rows.  JSON sources go
through ``scan_landed``; the others need more than one response (or more than
JSON) and are built here:

* feeds (bbc, ansa, gnews_it): ``from_xml`` gives one item variant per entry,
  then relevance, first wins by link and a top-k per task;
* talk pages (wikitalk): the section list and the wikitext may land apart; one
  aggregate per page puts them together before the positional zip;
* comments (youtube_comments): the quota per video is known from the search
  response before any comment is exploded;
* encyclopedia pages (wikipedia): ordered greedy assignment of pages to tasks;
* statistics (youtube): the latest landed before the run, joined by video.

Columns of a response beyond those of ``scan_landed``: ``_kind`` says what it is
(``search``, ``comments``, ``statistics``; null otherwise), ``_language`` and ``_page``
its language and page title, ``_video_id`` the video whose comments it holds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from renown import params as P
from renown.functions.text import keyword_relevant, py_strip
from renown.operators.dedup import first_per_key
from renown.session import discard, materialize, small_batches
from renown.sources.landed import (RSS_ITEM_SCHEMA, SCAN_RULES, rejected_responses, resolve_links, scan_landed,
                                   source_cap, talk_sections, task_index)

#: Feed sources with the length that a query term has to exceed to count; gnews_it searches on its own.
FEED_TERMS: dict[str, int] = {"bbc": 2, "ansa": 1}
FEEDS = ("bbc", "ansa", "gnews_it")
_TASK = ("source", "query", "target")
_OWN = ("wikitalk", "youtube_comments", "wikipedia")
MAX_VIDEOS_CAP = 10


def column(df: DataFrame, name: str, kind: str = "string") -> Column:
    """The column ``name`` of ``df``, null where it has none."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def _sequence(df: DataFrame) -> Column:
    return F.coalesce(column(df, "response_seq", "long"), F.lit(0)).cast("long")


# -- feeds ----------------------------------------------------------------------

def _feed_items(responses: DataFrame) -> DataFrame:
    """Feed responses with ``_items``: one variant per entry; null where the document can't be read."""
    parsed = F.from_xml("response", RSS_ITEM_SCHEMA, {"mode": "PERMISSIVE"})
    df = responses.where(F.col("source").isin(*FEEDS)).withColumn("_channel", parsed["channel"])

    def text(c):
        v = py_strip(c)
        return F.when(v != "", v)

    def entry(e):
        return F.to_variant_object(F.struct(
            *[text(e[k]).alias(k) for k in ("title", "link", "pubDate", "description")],
            text(e["source"]["_VALUE"]).alias("source_name"), e["source"]["_url"].alias("source_url")))

    none = F.array().cast("array<variant>")
    return df.withColumn("_items", F.when(F.col("_channel").isNotNull(), F.coalesce(
        F.transform("_channel.item", entry), none))).drop("_channel")


def scan_feeds(responses: DataFrame, max_results: int, redirects: DataFrame | None = None) -> DataFrame:
    """Feed responses -> raw rows; ``position`` is the place in the task's result.

    bbc and ansa: entries that a query term occurs in, first per link in feed
    order, newest first by the text of pubDate, ``max_results`` of them.
    gnews_it: the first ``max_results`` entries with their links resolved by
    ``redirects`` (link, final_url).
    """
    df = _feed_items(responses)
    cut = F.when(F.col("source") == "gnews_it", F.slice("_items", 1, source_cap("gnews_it", max_results))) \
           .otherwise(F.col("_items"))
    ex = df.select(*_TASK, "retrieved_at", _sequence(responses).alias("seq"), F.posexplode(cut).alias("pos", "item"))
    fields = {k: F.try_variant_get("item", f"$.{k}", "string") for k in ("title", "link", "description", "pubDate")}
    ex = ex.withColumns(fields).withColumn("at", F.struct("seq", "pos"))
    relevant = reduce(lambda a, s: a | ((F.col("source") == s) & keyword_relevant("query", "title", "description", FEED_TERMS[s])),
                      FEED_TERMS, F.lit(False))
    found = ex.where(F.col("source").isin(*FEED_TERMS) & relevant & (F.coalesce("link", F.lit("")) != ""))
    newest = Window.partitionBy(*_TASK).orderBy(F.coalesce("pubDate", F.lit("")).desc(), "at")
    top = first_per_key(found, [*_TASK, "link"], "at").withColumn("position", F.row_number().over(newest)) \
        .where(F.col("position") <= max_results)
    own = ex.where(F.col("source") == "gnews_it").withColumn("position", F.col("pos") + 1)
    if redirects is not None:
        own = resolve_links(own, redirects)
    resolved = F.to_json(F.struct("title", "link", "pubDate", "description",
                                  F.try_variant_get("item", "$.source_name", "string").alias("source_name"),
                                  F.try_variant_get("item", "$.source_url", "string").alias("source_url")),
                         {"ignoreNullFields": "false"})
    names = [*_TASK, "retrieved_at", "position", "payload"]
    top = top.withColumn("payload", F.to_json(F.struct("title", "link", "pubDate", "description"),
                                              {"ignoreNullFields": "false"}))
    # a gnews_it task has one response as a rule; the sequence keeps several apart
    return top.select(*names, F.lit(0).cast("long").alias("response_seq")).unionByName(
        own.withColumn("payload", resolved).select(*names, F.col("seq").alias("response_seq")))


# -- talk pages -------------------------------------------------------------------

_SECTIONS = "array<struct<line:string,level:string,anchor:string,index:string>>"


def assemble_talk_pages(responses: DataFrame) -> DataFrame:
    """One row per task and page: (task, lang, page_title, retrieved_at, sections, wikitext), null where nothing landed.

    Of several responses with a section list (a wikitext) the first by sequence counts.
    """
    v = F.try_parse_json("response")
    df = responses.where(F.col("source") == "wikitalk").select(
        *_TASK, "retrieved_at", F.coalesce(column(responses, "_language"), F.lit("en")).alias("lang"),
        F.coalesce(column(responses, "_page"), F.regexp_replace(F.try_variant_get(v, "$.parse.title", "string"), "^Talk:", ""))
         .alias("page_title"),
        F.struct(_sequence(responses).alias("seq"), "retrieved_at").alias("at"),
        F.try_variant_get(v, "$.parse.sections", _SECTIONS).alias("sections"),
        F.try_variant_get(v, "$.parse.wikitext['*']", "string").alias("wikitext"))
    has_list, has_text = F.size("sections") > 0, F.col("wikitext") != ""
    pages = df.where(F.col("page_title").isNotNull()).groupBy(*_TASK, "lang", "page_title").agg(
        F.min("retrieved_at").alias("retrieved_at"),
        F.min_by("sections", F.when(has_list, F.col("at"))).alias("sections"),
        F.min_by("wikitext", F.when(has_text, F.col("at"))).alias("wikitext"))
    number = F.transform("sections", lambda s: F.struct(
        F.coalesce(s["line"], F.lit("")).alias("line"), F.coalesce(s["level"].try_cast("int"), F.lit(2)).alias("level"),
        s["anchor"].alias("anchor"), s["index"].alias("index")))
    return pages.withColumn("sections", number)


def half_pages(pages: DataFrame) -> DataFrame:
    """Rejects of assembled talk pages that lack their section list or their wikitext."""
    reason = F.when(F.col("sections").isNull(), "missing_sections").when(F.col("wikitext").isNull(), "missing_wikitext")
    return pages.withColumn("reject_reason", reason).where(F.col("reject_reason").isNotNull()).select(
        *_TASK, "retrieved_at", F.to_json(F.struct("page_title", "lang")).alias("payload"), "reject_reason")


def scan_talk(pages: DataFrame, max_results: int, queries: list[str]) -> DataFrame:
    """Assembled talk pages -> one raw row per kept section.

    A page (language and title without case) belongs to the first task of its
    target, by query order, that got any section of it.
    """
    whole = pages.where(F.col("sections").isNotNull() & F.col("wikitext").isNotNull())
    with small_batches(pages.sparkSession):
        rows = materialize(talk_sections(whole, max_results).withColumn("task", task_index(queries)), "talk-sections")
    page = ["target", "lang", "page_key"]
    rows = rows.withColumn("page_key", F.lower("page_title"))
    first = rows.groupBy(*page).agg(F.min("task").alias("task"))
    kept = rows.join(first, [*page, "task"], "left_semi")
    payload = F.to_json(F.struct("page_title", "section_title", "section_index", "section_level", "wikitext", "url",
                                 F.col("lang").alias("language")), {"ignoreNullFields": "false"})
    return kept.select(*_TASK, "retrieved_at", F.col("section_number").alias("position"), payload.alias("payload"))


# -- comments ------------------------------------------------------------------------

def scan_comments(responses: DataFrame, max_results: int, max_videos: int = 3) -> DataFrame:
    """Search and comment responses -> one raw row per comment.

    The first ``max_videos`` (10 at most) results of a task's search are its
    videos; each gives ``max_results // videos`` comments (1 to 100), the task
    ``max_results``.  A comment response is cut to its quota before it is exploded.
    """
    own = responses.where(F.col("source") == "youtube_comments").withColumns(
        {"kind": column(responses, "_kind"), "video_id": column(responses, "_video_id"), "seq": _sequence(responses)})
    items = F.try_variant_get(F.try_parse_json("response"), "$.items", "array<variant>")
    own = own.withColumn("items", items)
    search = own.where("kind = 'search'").select(
        *_TASK, F.slice("items", 1, min(max_videos, MAX_VIDEOS_CAP)).alias("videos"))
    per_video = F.least(F.greatest(F.floor(F.lit(max_results) / F.size("videos")), F.lit(1)),
                        F.lit(P.SOURCE_CAPS["youtube_comments"])).cast("int")
    videos = search.select(*_TASK, per_video.alias("quota"), F.posexplode("videos").alias("place", "video")).select(
        *_TASK, "quota", "place", F.try_variant_get("video", "$.id.videoId", "string").alias("video_id"),
        F.coalesce(F.try_variant_get("video", "$.snippet.title", "string"), F.lit("")).alias("video_title"))
    videos = videos.where("video_id <> ''")
    found = own.where("kind = 'comments'").select(*_TASK, "video_id", "retrieved_at", "seq", "items") \
        .join(videos, [*_TASK, "video_id"])
    rows = found.select(*_TASK, "retrieved_at", "video_id", "video_title", "place", "seq",
                        F.posexplode(F.slice("items", F.lit(1), F.col("quota"))).alias("pos", "item"))
    # at most max(max_results, 10) rows a task come this far
    rank = F.row_number().over(Window.partitionBy(*_TASK).orderBy("place", "seq", "pos"))
    empty = F.parse_json(F.lit("{}"))
    payload = F.to_json(F.struct(
        F.coalesce(F.try_variant_get("item", "$.snippet.topLevelComment", "variant"), empty).alias("comment"),
        F.coalesce(F.try_variant_get("item", "$.snippet.totalReplyCount", "long"), F.lit(0)).alias("reply_count"),
        "video_id", "video_title"))
    return rows.withColumn("position", rank).where(F.col("position") <= max_results).select(
        *_TASK, "retrieved_at", "position", payload.alias("payload"))


# -- encyclopedia pages ----------------------------------------------------------------

def assign_in_order(choices: DataFrame, group: str, task: str, place: str, key: str, exists: str) -> DataFrame:
    """Ordered greedy assignment: (group, task, place) of the choice that each task of a group takes.

    Tasks go in ascending order, each through its choices by ``place``: a
    choice whose key an earlier task took ends the task without one, one
    that exists is taken, any other passes on to the next.

    It is worked out in rounds.  A task may act on its current choice once
    an earlier task has taken that key, or no earlier undecided task could still
    take it (the least task that could, per key, is one aggregate).  The first undecided task of
    a group can always act, so the rounds end; tasks without common keys act in the same
    round.  The rows of a round are written, the ones before deleted.
    """
    open_ = materialize(choices.select(F.col(group).alias("g"), F.col(task).alias("t"), F.col(place).alias("p"),
                                       F.col(key).alias("k"), F.col(exists).alias("e")), "assign-open")
    taken = None
    while not open_.isEmpty():
        current = open_.groupBy("g", "t").agg(F.min(F.struct("p", "k", "e")).alias("c")).select("g", "t", "c.*")
        able = open_.where("e").groupBy("g", "k").agg(F.min("t").alias("could"))
        now = current.join(able, ["g", "k"], "left")
        if taken is not None:
            now = now.join(taken.select("g", "k", F.col("t").alias("owner")), ["g", "k"], "left")
        else:
            now = now.withColumn("owner", F.lit(None).cast(now.schema["t"].dataType))
        spent = F.coalesce(F.col("owner") < F.col("t"), F.lit(False))
        now = now.where(spent | F.coalesce(F.col("could") >= F.col("t"), F.lit(True)))
        acted = materialize(now.select("g", "t", "p", "k", (~spent & F.col("e")).alias("takes"), (spent | F.col("e")).alias("done")),
                            "assign-acted")
        new = acted.where("takes").select("g", "t", "p", "k")
        before, taken = taken, materialize(new if taken is None else taken.unionByName(new), "assign-taken")
        left = open_.join(acted.where("done").select("g", "t"), ["g", "t"], "left_anti") \
                    .join(acted.where("NOT done").select("g", "t", "p"), ["g", "t", "p"], "left_anti")
        left = materialize(left, "assign-open")
        for old in (open_, acted, *([before] if before is not None else [])):
            discard(old)
        open_ = left
    if taken is None:
        taken = open_.select("g", "t", "p", "k")
    return taken.select(F.col("g").alias(group), F.col("t").alias(task), F.col("p").alias(place))


def scan_encyclopedia(responses: DataFrame, queries: list[str], languages: tuple[str, ...] = ("it", "en")) -> DataFrame:
    """Landed pages -> at most one raw row per task.

    A response holds ``title``, ``summary``, ``text`` and ``url`` of a page (``missing``: it
    does not exist; without a title nothing was found) in ``_language``.
    """
    v = F.try_parse_json("response")
    order = F.array(*[F.lit(x) for x in dict.fromkeys(languages)])
    df = responses.where(F.col("source") == "wikipedia").select(
        *_TASK, "retrieved_at", F.coalesce(column(responses, "_language"), F.lit(languages[0])).alias("language"),
        _sequence(responses).alias("seq"), task_index(queries).alias("task"),
        *[F.try_variant_get(v, f"$.{k}", "string").alias(k) for k in ("title", "summary", "text", "url")],
        F.coalesce(F.try_variant_get(v, "$.missing", "boolean"), F.lit(False)).alias("missing"))
    df = df.withColumn("place", F.struct(F.array_position(order, F.col("language")).alias("preference"), "seq"))
    df = materialize(df.where((F.col("place.preference") > 0) & (F.col("title") != "")), "encyclopedia-pages")
    picked = assign_in_order(
        df.select("target", "task", "place", F.concat("language", F.lit(":"), F.lower("title")).alias("key"),
                  (~F.col("missing")).alias("exists")), "target", "task", "place", "key", "exists")
    fields = [F.coalesce(k, F.lit("")).alias(k) for k in ("title", "summary", "text", "url")]
    return df.join(picked, ["target", "task", "place"], "left_semi").select(
        *_TASK, "retrieved_at", F.lit(1).alias("position"), F.to_json(F.struct(*fields, "language")).alias("payload"))


# -- video statistics -------------------------------------------------------------------

def latest_statistics(responses: DataFrame, as_of: str | None = None) -> DataFrame:
    """(video_id, statistics): of each video the last that landed, up to the day ``as_of``."""
    df = responses.where((F.col("source") == "youtube") & (column(responses, "_kind") == "statistics"))
    if as_of is not None:
        df = df.where(F.substring("retrieved_at", 1, 10) <= as_of)
    items = F.try_variant_get(F.try_parse_json("response"), "$.items", "array<variant>")
    df = df.select("retrieved_at", _sequence(responses).alias("seq"), F.posexplode(items).alias("pos", "item")).select(
        F.struct("retrieved_at", "seq", "pos").alias("at"), F.try_variant_get("item", "$.id", "string").alias("video_id"),
        F.to_json(F.try_variant_get("item", "$.statistics", "variant")).alias("statistics"))
    df = df.where(F.col("video_id").isNotNull()).groupBy("video_id").agg(F.max_by("statistics", "at").alias("statistics"))
    return materialize(df, "video-statistics")  # from files, so AQE may split a hot video


def with_statistics(raw: DataFrame, statistics: DataFrame) -> DataFrame:
    """youtube rows with ``statistics`` in their payload ({} where none landed); other rows as they are."""
    v, kind = F.try_parse_json("payload"), "map<string,variant>"
    video = F.when(F.col("source") == "youtube", F.try_variant_get(v, "$.id.videoId", "string"))
    empty = F.parse_json(F.lit("{}"))
    body = F.try_variant_get(v, "$", kind)
    own = F.map_filter(body, lambda k, _: k != "statistics")
    full = F.to_json(F.map_concat(own, F.create_map(F.lit("statistics"), F.coalesce(F.try_parse_json("statistics"), empty))),
                     {"ignoreNullFields": "false"})
    joined = raw.withColumn("video_id", video).join(statistics, "video_id", "left")
    return joined.withColumn("payload", F.when(F.col("source") == "youtube", full).otherwise(F.col("payload"))) \
        .drop("video_id", "statistics")


# -- the run ----------------------------------------------------------------------------

def main_responses(responses: DataFrame) -> DataFrame:
    """Responses that ``scan_landed`` reads: JSON sources, statistics left out."""
    return responses.where(F.col("source").isin(*SCAN_RULES) & column(responses, "_kind").isNull())


def scan_run(responses: DataFrame, queries: list[str], max_results: int, slice_all: bool = False,
             redirects: DataFrame | None = None, as_of: str | None = None, max_videos: int = 3,
             languages: tuple[str, ...] = ("it", "en")) -> tuple[DataFrame, DataFrame]:
    """(raw rows, rejected responses) of landed responses of every source.

    Each part filters the landing table by source, so a table that is
    partitioned by source is read once in all.
    """
    raw = scan_landed(main_responses(responses), max_results, slice_all)
    if "_kind" in responses.columns:
        json_rows = raw.where("source <> 'youtube'")
        videos = with_statistics(raw.where("source = 'youtube'"), latest_statistics(responses, as_of))
        raw = json_rows.unionByName(videos)
    pages = materialize(assemble_talk_pages(responses), "talk-pages")
    for part in (scan_feeds(responses, max_results, redirects), scan_talk(pages, max_results, queries),
                 scan_comments(responses, max_results, max_videos), scan_encyclopedia(responses, queries, languages)):
        raw = raw.unionByName(part, allowMissingColumns=True)
    return raw, rejected_run(responses).unionByName(half_pages(pages))


def rejected_run(responses: DataFrame) -> DataFrame:
    """Responses of any source that can't be read or that hold an error."""
    v = F.try_parse_json("response")
    json_kinds = responses.where(F.col("source").isin(*_OWN) | column(responses, "_kind").isNotNull())
    fault = F.when(v.isNull(), "invalid_response").when(F.try_variant_get(v, "$.error", "variant").isNotNull(), "error_response")
    feeds = _feed_items(responses).withColumn("_fault", F.when(F.col("_items").isNull(), "invalid_response"))
    names = [*_TASK, "retrieved_at", F.col("response").alias("payload"), F.col("_fault").alias("reject_reason")]
    return rejected_responses(main_responses(responses)).unionByName(
        json_kinds.withColumn("_fault", fault).where("_fault IS NOT NULL").select(*names)).unionByName(
        feeds.where("_fault IS NOT NULL").select(*names))
