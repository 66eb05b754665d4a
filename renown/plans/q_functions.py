"""Scalar-function queries (text, url, date, number) over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from renown import params as P
from renown.functions import dates as D
from renown.functions import text as TX
from renown.functions import urls as U
from renown.operators.clean import clean_records
from renown.plans import oracle as O
from renown.plans.registry import query
from renown.sources import fixtures as X

S = O.sql_strip
WS = O.WS
PY_WS = O.PY_WS

_PAGE_PARTS = r"""
pp AS (SELECT page_id, url, html,
              regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title_html,
              regexp_extract(html, '(?s)<body>(.*)</body>', 1) AS body_html
       FROM pages)"""


@query("canonical_url", f"""WITH {_PAGE_PARTS}
SELECT page_id, {O.sql_canonical_url('url', 'page_id % 2 = 0')} AS url_key FROM pp""")
def canonical_url(spark, sf_dir):
    pp = X.page_parts(spark, sf_dir)
    return pp.select("page_id", U.canonical_url("url", F.col("page_id") % 2 == 0).alias("url_key"))


_CODED_URL = "url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'q=' || replace(replace(title_html, '&', '%26'), ' ', '+')" \
    " || '&a+%zz=1&a%20%zz=' || page_id || '&utm_source=x&%C3%A9=%e4%bd%a0%&b&c=d=e%2f~*&empty=&gclid'"


@query("canonical_url_codec", f"""WITH {_PAGE_PARTS},
c AS (SELECT page_id, {_CODED_URL} AS coded FROM pp)
SELECT page_id, {O.sql_canonical_url('coded', 'page_id % 2 = 0')} AS url_key FROM c""")
def canonical_url_codec(spark, sf_dir):
    """Url keys of queries with escapes, bad escapes, repeated and blank keys (the title of each page as a value)."""
    coded = X.page_parts(spark, sf_dir).withColumn("coded", F.expr(_CODED_URL))
    return coded.select("page_id", U.canonical_url("coded", F.col("page_id") % 2 == 0).alias("url_key"))


@query("canonical_title", f"""WITH {_PAGE_PARTS}
SELECT page_id, {O.sql_canonical_title('title_html')} AS title_key FROM pp""")
def canonical_title(spark, sf_dir):
    pp = X.page_parts(spark, sf_dir)
    return pp.select("page_id", U.canonical_title("title_html").alias("title_key"))


@query("truncate_text", f"""
SELECT doc_id, {O.sql_truncate('text')} AS text_cut, length({O.sql_truncate('text')}) AS n_cut FROM documents""")
def truncate_text(spark, sf_dir):
    docs = X.table(spark, sf_dir, "documents")
    cut = TX.truncate_text("text")
    return docs.select("doc_id", cut.alias("text_cut"), F.length(cut).cast("bigint").alias("n_cut"))


@query("strip_html", f"""WITH {_PAGE_PARTS}
SELECT page_id, {O.sql_strip_html('title_html')} AS title_text, {O.sql_strip_html('body_html')} AS body_text FROM pp""")
def strip_html(spark, sf_dir):
    pp = X.page_parts(spark, sf_dir)
    return pp.select("page_id", TX.strip_html("title_html").alias("title_text"),
                     TX.strip_html("body_html").alias("body_text"))


def _sql_clean(x: str) -> str:
    s = S(f"coalesce({x}, '')")
    s = O.sql_unescape_basic(s)
    s = (f"regexp_replace({s}, '[\\x{{00}}-\\x{{08}}\\x{{0B}}\\x{{0C}}\\x{{0E}}-\\x{{1F}}"
         f"\\x{{7F}}-\\x{{9F}}\\x{{2028}}\\x{{2029}}]', '', 'g')")
    s = f"regexp_replace({s}, '[ \\t\\x{{A0}}]+', ' ', 'g')"
    return f"nfc_normalize({S(s)})"


@query("clean_text", O.with_r(f"""
x AS (SELECT 1)
SELECT ord, {_sql_clean('title')} AS title, {O.sql_truncate(_sql_clean('text'))} AS text,
       {_sql_clean('url')} AS url, {_sql_clean('domain')} AS domain,
       nullif({_sql_clean('author')}, '') AS author, nullif({_sql_clean('language')}, '') AS language
FROM r"""))
def clean_text(spark, sf_dir):
    return clean_records(X.records(spark, sf_dir)).select(
        "ord", "title", "text", "url", "domain", "author", "language")


def _case_map(expr: str, d: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in d.items())
    return f"CASE {expr} {whens} END"


_RAW_LANG = """
rl AS (SELECT doc_id, CASE doc_id % 7
    WHEN 0 THEN lang
    WHEN 1 THEN upper(lang) || '-US'
    WHEN 2 THEN '  ' || lang || '_br '
    WHEN 3 THEN CASE lang WHEN 'de' THEN 'deu' WHEN 'en' THEN 'eng' WHEN 'es' THEN 'spa' WHEN 'fr' THEN 'fra' END
    WHEN 4 THEN CASE lang WHEN 'de' THEN 'German' WHEN 'en' THEN 'english' WHEN 'es' THEN 'SPANISH' WHEN 'fr' THEN 'French' END
    WHEN 5 THEN 'klingon'
    ELSE '' END AS raw FROM documents)"""


def sql_language_code(x: str) -> str:
    norm = f"lower({S(x)})"
    primary = f"split_part(split_part({norm}, '-', 1), '_', 1)"
    iso3 = _case_map(primary, P.ISO3_TO_ISO1)
    name = _case_map(norm, P.LANG_NAME_TO_ISO1)
    return (f"CASE WHEN {x} IS NULL OR {x} = '' THEN NULL WHEN length({primary}) = 2 THEN {primary} "
            f"WHEN length({primary}) = 3 AND {iso3} IS NOT NULL THEN {iso3} ELSE {name} END")


@query("language_code", f"""WITH {_RAW_LANG}
SELECT doc_id, raw, {sql_language_code('raw')} AS language FROM rl""")
def language_code(spark, sf_dir):
    rl = X.raw_language(spark, sf_dir)
    return rl.select("doc_id", "raw", TX.language_code("raw").alias("language"))


_QH = """
qh AS (SELECT doc_id, title,
              CASE WHEN doc_id % 3 = 0 THEN split_part(title, ' ', 1) || ' Smith'
                   ELSE 'Entity ' || CAST(doc_id % 5 AS VARCHAR) END AS target
       FROM (SELECT doc_id, text AS title FROM documents))"""


def _sql_build_query(t: str, tp: str) -> str:
    words = O.sql_split(f"lower({t})")
    return (f"CASE WHEN len(list_filter({words}, lambda w: contains(lower({tp}), w))) > 0 "
            f"THEN {tp} ELSE concat_ws(' ', {t}, {tp}) END")


def _sql_extract_topic(t: str, q: str) -> str:
    return (f"CASE WHEN starts_with(lower({q}), lower({t} || ' ')) "
            f"THEN substring({q}, length({t} || ' ') + 1) ELSE {q} END")


def _sql_slug(x: str) -> str:
    s = S(f"lower({x})")
    s = f"regexp_replace({s}, '[^\\p{{L}}\\p{{N}}_{PY_WS}-]', '', 'g')"
    s = f"regexp_replace({s}, '[{PY_WS}-]+', '_', 'g')"
    s = f"regexp_replace({s}, '_+', '_', 'g')"
    s = f"regexp_replace({s}, '^_+|_+$', '', 'g')"
    return f"substring({s}, 1, 30)"


def _sql_hashtag(x: str) -> str:
    words = O.sql_split(f"regexp_replace({x}, '[^\\p{{L}}\\p{{N}}_{PY_WS}]', '', 'g')")
    return (f"array_to_string(list_transform({words}, "
            f"lambda w: CASE WHEN substring(w, 1, 1) = 'ß' THEN 'Ss' ELSE upper(substring(w, 1, 1)) END"
            f" || lower(substring(w, 2))), '')")


def _sql_gdelt(x: str) -> str:
    kept = (f"list_filter({O.sql_split(S(x))}, "
            f"lambda t: length(regexp_replace(t, '[^\\p{{L}}\\p{{N}}_]', '', 'g')) >= {P.GDELT_MIN_TOKEN_WORD_CHARS})")
    return f"CASE WHEN len({kept}) > 0 THEN array_to_string({kept}, ' ') ELSE '\"' || {S(x)} || '\"' END"


@query("query_helpers", f"""WITH {_QH},
q AS (SELECT doc_id, title, target, {_sql_build_query('target', 'title')} AS query FROM qh)
SELECT doc_id, target, query, {_sql_extract_topic('target', 'query')} AS topic,
       {_sql_slug('title')} AS slug, {_sql_hashtag('title')} AS hashtag, {_sql_gdelt('title')} AS gdelt_query
FROM q""")
def query_helpers(spark, sf_dir):
    docs = X.spread(X.table(spark, sf_dir, "documents").select("doc_id", "text"))
    qh = docs.select("doc_id", F.col("text").alias("title"))
    target = F.when(F.col("doc_id") % 3 == 0, F.concat(F.split("title", " ").getItem(0), F.lit(" Smith"))) \
              .otherwise(F.concat(F.lit("Entity "), (F.col("doc_id") % 5).cast("string")))
    q = qh.withColumn("target", target).withColumn("query", TX.build_query("target", "title"))
    return q.select(
        "doc_id", "target", "query",
        TX.extract_topic("target", "query").alias("topic"),
        TX.target_slug("title").alias("slug"),
        TX.query_to_hashtag("title").alias("hashtag"),
        TX.sanitize_gdelt_query("title").alias("gdelt_query"),
    )


def _sql_to_url(x: str) -> str:
    s = S(x)
    u = f"CASE WHEN starts_with({s}, 'http://') OR starts_with({s}, 'https://') THEN {s} ELSE 'https://' || {s} END"
    net = f"regexp_extract({u}, '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?//([^/?#]*)', 1)"
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN '' WHEN {net} <> '' THEN {u} ELSE '' END"


@query("to_url_domain", f"""
WITH p AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN url WHEN 1 THEN regexp_replace(url, '^https?://', '')
                                ELSE '  ' || url END AS raw FROM pages),
u AS (SELECT page_id, raw, {_sql_to_url('raw')} AS url FROM p)
SELECT page_id, url, regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?//([^/?#]*)', 1) AS domain FROM u""")
def to_url_domain(spark, sf_dir):
    pages = X.table(spark, sf_dir, "pages")
    k = F.col("page_id") % 3
    raw = F.when(k == 0, F.col("url")).when(k == 1, F.regexp_replace("url", "^https?://", "")) \
           .otherwise(F.concat(F.lit("  "), F.col("url")))
    u = pages.select("page_id", U.to_url(raw).alias("url"))
    return u.select("page_id", "url", U.to_domain("url").alias("domain"))


_EV_DATES = """
ed AS (SELECT event_id, ts, value, props, CASE event_id % 6
    WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
    WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S-05:00')
    WHEN 2 THEN strftime(ts, '%Y%m%dT%H%M%SZ')
    WHEN 3 THEN strftime(ts, '%a, %d %b %Y %H:%M:%S +0000')
    WHEN 4 THEN strftime(ts, '%Y-%m-%d')
    ELSE 'not a date ' || CAST(event_id AS VARCHAR) END AS raw FROM events)"""


def _sql_to_date(x: str) -> str:
    s = S(x)
    iso = f"regexp_extract({s}, '^(\\d{{4}}-\\d{{2}}-\\d{{2}})(?:$|[T ])', 1)"
    compact = f"regexp_extract({s}, '^(\\d{{8}})(?:$|T)', 1)"
    rfc_re = "(?:^|[\\s,])(\\d{1,2})\\s+([A-Za-z]{3})[A-Za-z]*\\.?\\s+(\\d{4})\\b"
    rd, rm, ry = (f"regexp_extract({s}, '{rfc_re}', {i})" for i in (1, 2, 3))
    return (f"coalesce(CASE WHEN {iso} <> '' THEN CAST(try_strptime({iso}, '%Y-%m-%d') AS DATE) END, "
            f"CASE WHEN {compact} <> '' THEN CAST(try_strptime({compact}, '%Y%m%d') AS DATE) END, "
            f"CASE WHEN {rd} <> '' THEN CAST(try_strptime({rd} || ' ' || {rm} || ' ' || {ry}, '%d %b %Y') AS DATE) END)")


@query("parse_dates", f"""WITH {_EV_DATES}
SELECT event_id, raw, {_sql_to_date('raw')} AS date FROM ed""")
def parse_dates(spark, sf_dir):
    ed = X.event_dates(spark, sf_dir)
    return ed.select("event_id", "raw", D.to_date("raw").alias("date"))


@query("epoch_date", """
SELECT event_id,
       CAST(DATE '1970-01-01' + CAST(floor(epoch(ts) / 86400.0) AS INTEGER) AS DATE) AS date_from_float,
       CAST(DATE '1970-01-01' + CAST(floor(CAST(floor(epoch(ts)) AS BIGINT) / 86400.0) AS INTEGER) AS DATE)
         AS date_from_int
FROM events""")
def epoch_date(spark, sf_dir):
    ev = X.table(spark, sf_dir, "events")
    # seconds since the epoch of the wall-clock (NTZ) value, independent of the session time zone
    ts = F.col("ts")
    secs = (F.unix_date(F.to_date(ts)).cast("double") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60
            + F.second(ts))
    return ev.select("event_id", D.epoch_to_date(secs).alias("date_from_float"),
                     D.epoch_to_date(F.floor(secs).cast("bigint")).alias("date_from_int"))


def _sql_to_int_str(x: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({x}), '[+-]?[0-9]+') THEN CAST(trim({x}) AS BIGINT) END"


@query("to_int", f"""
SELECT event_id,
       CAST(trunc(value) AS BIGINT) AS value_int,
       {_sql_to_int_str("json_extract_string(props, '$.k')")} AS k_int,
       {_sql_to_int_str("CAST(value AS VARCHAR)")} AS value_text_int
FROM events""")
def to_int(spark, sf_dir):
    ev = X.table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        D.to_int("value").alias("value_int"),
        D.to_int(F.get_json_object("props", "$.k")).alias("k_int"),
        D.to_int(F.col("value").cast("string")).alias("value_text_int"),
    )


def _sql_html_to_text(x: str) -> str:
    t = f"regexp_replace(coalesce({x}, ''), '<br\\s*/?>', chr(10), 'g')"
    t = f"regexp_replace({t}, '</p>\\s*<p>', chr(10) || chr(10), 'g')"
    t = O.sql_unescape_basic(f"regexp_replace({t}, '<[^>]+>', '', 'g')")
    lines = (f"list_filter(list_transform(regexp_split_to_array({t}, "
             f"'\\r\\n|[\\n\\r\\x{{0B}}\\x{{0C}}\\x{{1C}}\\x{{1D}}\\x{{1E}}\\x{{85}}\\x{{2028}}\\x{{2029}}]'), "
             f"lambda l: {S('l')}), lambda l: l <> '')")
    return S(f"array_to_string({lines}, chr(10))")


@query("html_to_text", f"""WITH {_PAGE_PARTS}
SELECT page_id, {_sql_html_to_text('body_html')} AS text FROM pp""")
def html_to_text(spark, sf_dir):
    pp = X.page_parts(spark, sf_dir)
    return pp.select("page_id", TX.mastodon_html_to_text("body_html").alias("text"))


@query("first_non_empty", O.with_r(f"""
x AS (SELECT 1)
SELECT ord, coalesce(nullif({S("CASE WHEN ord % 2 = 0 THEN '  ' ELSE NULL END")}, ''),
                     nullif({S('title')}, ''), nullif({S('text')}, ''), '') AS picked
FROM r"""))
def first_non_empty(spark, sf_dir):
    r = X.records(spark, sf_dir)
    blank = F.when(F.col("ord") % 2 == 0, F.lit("  "))
    return r.select("ord", TX.first_non_empty(blank, "title", "text").alias("picked"))


@query("run_timestamp", "SELECT event_id, strftime(ts, '%Y%m%dT%H%M%SZ') AS stamp FROM events")
def run_timestamp(spark, sf_dir):
    """The run stamp of each event's instant (its wall clock is UTC)."""
    instant = F.from_utc_timestamp(F.col("ts"), F.current_timezone())
    return X.table(spark, sf_dir, "events").select("event_id", D.run_timestamp(instant).alias("stamp"))
