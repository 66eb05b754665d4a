"""Reference SQL (DuckDB dialect) for every registered query.

Each statement re-derives the fixture views from the raw test tables with
the same rules as ``sources/fixtures.py`` and computes the operator's
result independently of Spark.  Column names equal the Spark queries'.
"""

from __future__ import annotations

from renown import params as P

_SOURCES_LIST = "[" + ", ".join(f"'{s}'" for s in P.SOURCE_ORDER) + "]"
_WEIGHTS_VALUES = ", ".join(f"('{k}', CAST({v} AS DOUBLE))" for k, v in P.SOURCE_WEIGHTS.items())
AS_OF = "DATE '2024-12-31'"

# Records view R (see fixtures.records).
R_CTE = f"""
r AS (
  SELECT
    d.doc_id AS ord,
    CASE WHEN d.doc_id % 19 = 0 THEN 'forum' ELSE {_SOURCES_LIST}[d.doc_id % 18 + 1] END AS source,
    'Entity ' || CAST(d.doc_id // 2 % 5 AS VARCHAR) AS target,
    'Entity ' || CAST(d.doc_id // 2 % 5 AS VARCHAR) || ' ' || d.source AS query,
    d.source AS topic,
    regexp_extract(d.text, '^[^.\\n]*') AS title,
    d.text AS text,
    CASE WHEN d.doc_id % 11 = 0 THEN NULL
         ELSE CAST(DATE '2024-01-01' + CAST((d.doc_id * 7) % 365 AS INTEGER) AS DATE) END AS date,
    'https://' || CASE WHEN d.doc_id % 2 = 1 THEN upper(d.h) ELSE d.h END
      || '/a/' || CAST(d.doc_id // 2 AS VARCHAR)
      || CASE WHEN d.doc_id % 3 = 0 THEN '/' ELSE '' END
      || CASE WHEN d.doc_id % 4 = 1 THEN '?utm_source=feed' ELSE '' END AS url,
    CAST(NULL AS VARCHAR) AS author,
    CASE WHEN d.doc_id % 4 = 0 THEN NULL ELSE d.lang END AS language,
    CASE WHEN d.doc_id % 23 = 0 THEN 'consent.google.com' ELSE d.h END AS domain,
    '2024-12-31T00:00:00+00:00' AS retrieved_at,
    CAST(d.n_chars AS BIGINT) AS views_count,
    CAST(NULL AS BIGINT) AS likes_count,
    CAST(NULL AS BIGINT) AS comments_count,
    CAST(l.quality - l.toxic AS DOUBLE) AS sentiment
  FROM (SELECT *, 'site' || CAST((doc_id // 2) % 13 AS VARCHAR) || '.example.org' AS h FROM documents) d
  LEFT JOIN labels l ON l.doc_id = d.doc_id
),
rw AS (
  SELECT r.*, COALESCE(sw.w, CAST(0.5 AS DOUBLE)) AS w
  FROM r LEFT JOIN (VALUES {_WEIGHTS_VALUES}) AS sw(source, w) ON sw.source = r.source
)"""


def summary_sql(records_cte: str = "rw") -> str:
    """Reputation summary over a CTE with (target, source, ord, query, topic, sentiment, date, w)."""
    return f"""
s_mu AS (
  SELECT target,
         greatest(-1.0, least(1.0, sum(sentiment * w) / sum(w) FILTER (WHERE sentiment IS NOT NULL))) AS mu
  FROM {records_cte} GROUP BY target
),
s_dist AS (
  SELECT target, string_agg(source || ':' || CAST(n AS VARCHAR), ',' ORDER BY n DESC, first_ord) AS source_distribution
  FROM (SELECT target, source, count(*) AS n, min(ord) AS first_ord FROM {records_cte} GROUP BY target, source)
  GROUP BY target
),
s_xy AS (
  SELECT target, CAST(count(*) AS BIGINT) AS nxy,
         CAST(sum(x) AS HUGEINT) AS sx, sum(sentiment) AS sy, sum(x * sentiment) AS sxy,
         CAST(sum(x * x) AS HUGEINT) AS sxx
  FROM (SELECT target, sentiment,
               CAST(date - min(date) OVER (PARTITION BY target) AS BIGINT) AS x
        FROM {records_cte} WHERE date IS NOT NULL AND sentiment IS NOT NULL)
  GROUP BY target
),
s_main AS (
  SELECT t.target,
    string_agg(DISTINCT t.query, '|' ORDER BY t.query) FILTER (WHERE t.query <> '') AS queries,
    string_agg(DISTINCT t.topic, '|' ORDER BY t.topic) FILTER (WHERE t.topic <> '') AS topics,
    CAST(count(*) AS BIGINT) AS record_count,
    CAST(count(t.sentiment) AS BIGINT) AS records_with_sentiment,
    CASE WHEN count(t.sentiment) > 0 THEN round(any_value(m.mu), 6) END AS sentiment_avg,
    CASE WHEN count(t.sentiment) >= 2 THEN
      round(sqrt(sum(t.w * (t.sentiment - m.mu) * (t.sentiment - m.mu)) FILTER (WHERE t.sentiment IS NOT NULL)
                 / sum(t.w) FILTER (WHERE t.sentiment IS NOT NULL)), 6) END AS sentiment_std,
    round(coalesce(avg(t.w) FILTER (WHERE t.w >= {P.MIN_SOURCE_TRUST}), avg(t.w)), 6) AS source_trust_avg,
    round(coalesce(avg(pow(2.0, -greatest(0, {AS_OF} - t.date) / {float(P.RECENCY_HALF_LIFE_DAYS)}))
                   FILTER (WHERE t.date IS NOT NULL), 0.0), 6) AS recency_score,
    round(ln(1 + count(*)) / (ln(1 + count(*)) + ln(1 + {P.VOLUME_HALFSAT})), 6) AS volume_score,
    min(t.date) AS date_from, max(t.date) AS date_to
  FROM {records_cte} t JOIN s_mu m ON m.target = t.target
  GROUP BY t.target
)
SELECT s.target AS entity, s.queries, s.topics, s.record_count, s.records_with_sentiment,
       d.source_distribution, s.sentiment_avg, s.sentiment_std, s.source_trust_avg,
       s.recency_score, s.volume_score,
       CASE WHEN coalesce(x.nxy, 0) < {P.MIN_RECORDS_FOR_TREND} THEN 'unknown'
            WHEN x.nxy * x.sxx - x.sx * x.sx = 0 THEN 'stable'
            WHEN (x.nxy * x.sxy - CAST(x.sx AS DOUBLE) * x.sy) / CAST(x.nxy * x.sxx - x.sx * x.sx AS DOUBLE)
                 > {P.TREND_THRESHOLD} THEN 'up'
            WHEN (x.nxy * x.sxy - CAST(x.sx AS DOUBLE) * x.sy) / CAST(x.nxy * x.sxx - x.sx * x.sx AS DOUBLE)
                 < -{P.TREND_THRESHOLD} THEN 'down'
            ELSE 'stable' END AS trend,
       s.date_from, s.date_to,
       round(greatest(0.0, least(1.0,
             {P.REPUTATION_WEIGHTS['sentiment']} * coalesce((s.sentiment_avg + 1.0) / 2.0, 0.5)
           + {P.REPUTATION_WEIGHTS['trust']} * s.source_trust_avg
           + {P.REPUTATION_WEIGHTS['recency']} * s.recency_score
           + {P.REPUTATION_WEIGHTS['volume']} * s.volume_score)), 4) AS reputation_score
FROM s_main s JOIN s_dist d ON d.target = s.target LEFT JOIN s_xy x ON x.target = s.target
"""


def with_r(body: str) -> str:
    return f"WITH {R_CTE},\n{body}"


# ---------------------------------------------------------------------------
# SQL spellings of the column functions (RE2 regexes, DuckDB built-ins)
# ---------------------------------------------------------------------------

PY_WS = (r"\t\n\x{0B}\x{0C}\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
         r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
WS = f"[{PY_WS}]"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def sql_split(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WS}+'), lambda t: t <> '')"


def sql_truncate(x: str, n: int = P.MAX_TEXT_LENGTH) -> str:
    head = f"substring({x}, 1, {n})"
    punct = f"regexp_extract({head}, '(?s)^(.*[.!?])', 1)"
    space = f"regexp_extract({head}, '(?s)^(.*) ', 1)"
    return (f"CASE WHEN length({x}) <= {n} THEN {x} "
            f"WHEN length({punct}) > {n // 2 + 1} THEN {punct} "
            f"WHEN length({space}) > {n // 2} THEN {space} ELSE {head} END")


def sql_unescape_basic(x: str) -> str:
    """The named entities present in the test pages, decoded in one pass order."""
    s = x
    for ent, ch in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"),
                    ("&lt;", "<"), ("&gt;", ">"), ("&#39;", "''"), ("&amp;", "&"), ("&amp", "&")):
        s = f"replace({s}, '{ent}', '{ch}')"
    return s


def sql_strip_html(x: str) -> str:
    return sql_strip(sql_unescape_basic(f"regexp_replace(coalesce({x}, ''), '<[^>]+>', '', 'g')"))


def sql_canonical_title(x: str) -> str:
    t = f"regexp_replace(lower(coalesce({x}, '')), '[^\\p{{L}}\\p{{N}}_{PY_WS}]', '', 'g')"
    t = f"regexp_replace({t}, '{WS}+', ' ', 'g')"
    return sql_strip(t)


_TRACKING = "[" + ", ".join(f"'{t}'" for t in P.TRACKING_PARAMS) + "]"
_URL_RE = r"(?s)^(?:([a-z][a-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def _sql_dec(x: str) -> str:
    """Form decoding as the key is defined: plus to space, escapes to bytes, what is no escape stays."""
    parts = f"regexp_extract_all(replace({x}, '+', ' '), '%[0-9A-Fa-f]{{2}}|[^%]+|%')"
    one = "CASE WHEN regexp_full_match(t, '%[0-9A-Fa-f]{2}') THEN upper(t[2:]) ELSE hex(encode(t)) END"
    return f"decode(unhex(array_to_string(list_transform({parts}, lambda t: {one}), '')))"


def _sql_enc(x: str) -> str:
    """Form encoding, character by character."""
    one = ("CASE WHEN regexp_full_match(t, '[A-Za-z0-9_.~-]') THEN t WHEN t = ' ' THEN '+' "
           "ELSE regexp_replace(hex(encode(t)), '(..)', '%\\1', 'g') END")
    return f"array_to_string(list_transform(string_split({x}, ''), lambda t: {one}), '')"


def sql_canonical_url(x: str, keep_frag: str) -> str:
    u = sql_strip(f"lower({x})")
    g = lambda i: f"regexp_extract({u}, '{_URL_RE}', {i})"
    dk = _sql_dec("split_part(p, '=', 1)")
    dv = _sql_dec("substring(p, strpos(p, '=') + 1)")
    kv = (f"list_transform(list_filter(string_split({g(4)}, '&'), lambda p: p <> ''), "
          f"lambda p: {{'k': {dk}, 'v': CASE WHEN contains(p, '=') THEN {dv} ELSE '' END}})")
    kept = f"list_filter({kv}, lambda e: NOT list_contains({_TRACKING}, e.k))"
    keys = f"list_transform({kept}, lambda e: e.k)"
    ukeys = f"list_filter({keys}, lambda k, i: list_position({keys}, k) = i)"
    grouped = (f"flatten(list_transform({ukeys}, lambda k: list_transform(list_filter({kept}, lambda e: e.k = k), "
               f"lambda e: {_sql_enc('e.k')} || '=' || {_sql_enc('e.v')})))")
    cq = f"array_to_string({grouped}, '&')"
    path_all = g(3)
    path = f"regexp_replace(regexp_extract({path_all}, '(?s)^(.*?)((?:;[^/]*)?)$', 1), '/+$', '')"
    params = f"regexp_extract({path_all}, '(?s)^(.*?)((?:;[^/]*)?)$', 2)"
    has_auth = f"regexp_extract({u}, '(?s)^(?:[a-z][a-z0-9+.\\-]*:)?(//)', 1) <> ''"
    out = (f"(CASE WHEN {g(1)} <> '' THEN {g(1)} || ':' ELSE '' END"
           f" || CASE WHEN {has_auth} THEN '//' || {g(2)} ELSE '' END"
           f" || {path} || {params}"
           f" || CASE WHEN {cq} <> '' THEN '?' || {cq} ELSE '' END"
           f" || CASE WHEN ({keep_frag}) AND {g(5)} <> '' THEN '#' || {g(5)} ELSE '' END)")
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN '' ELSE {out} END"
