"""Filter queries over the fixture views."""

from __future__ import annotations


from renown import params as P
from renown.operators import filters as FL
from renown.plans import oracle as O
from renown.plans.registry import query
from renown.sources import fixtures as X

_BLOCKED = "(" + ", ".join(f"'{d}'" for d in sorted(P.BLOCKED_DOMAINS)) + ")"
SINCE = "2024-07-01"
LANGS = ("EN", " de ")


@query("quality_filter", O.with_r(f"""
x AS (SELECT 1)
SELECT ord, source, domain FROM r
WHERE NOT (coalesce(domain, '') <> '' AND domain IN {_BLOCKED})
  AND (length(coalesce(text, '')) >= {P.MIN_TEXT_LENGTH} OR length(coalesce(title, '')) >= {P.MIN_TITLE_LENGTH})"""))
def quality_filter(spark, sf_dir):
    return FL.filter_quality(X.records(spark, sf_dir)).select("ord", "source", "domain")


@query("since_filter", O.with_r(f"""
x AS (SELECT 1)
SELECT ord, date FROM r WHERE date IS NULL OR date >= DATE '{SINCE}'"""))
def since_filter(spark, sf_dir):
    return FL.filter_by_date(X.records(spark, sf_dir), SINCE).select("ord", "date")


@query("language_filter", O.with_r("""
x AS (SELECT 1)
SELECT ord, language FROM r WHERE language IS NULL OR lower(language) IN ('en', 'de')"""))
def language_filter(spark, sf_dir):
    return FL.filter_by_language(X.records(spark, sf_dir), LANGS).select("ord", "language")


def _reply_pairs_sql() -> str:
    return """
SELECT a.conv_id, a.turn, u.text AS query, CAST(NULL AS VARCHAR) AS title, a.text AS description
FROM conversations a JOIN conversations u ON u.conv_id = a.conv_id AND u.turn = a.turn - 1
WHERE a.role = 'assistant' AND u.role = 'user'"""


@query("keyword_relevance", f"""
WITH p AS ({_reply_pairs_sql()}),
t AS (SELECT conv_id, turn,
             list_transform(list_filter({O.sql_split('query')}, lambda w: length(w) > 2), lambda w: lower(w)) AS terms,
             lower(concat_ws(' ', nullif(title, ''), nullif(description, ''))) AS hay
      FROM p)
SELECT conv_id, turn FROM t
WHERE len(terms) = 0 OR len(list_filter(terms, lambda w: contains(hay, w))) > 0""")
def keyword_relevance(spark, sf_dir):
    pairs = X.reply_pairs(spark, sf_dir)
    return FL.filter_relevant(pairs, "query", "title", "description", 2).select("conv_id", "turn")
