"""Deduplication queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from renown import params as P
from renown.operators.dedup import deduplicate, first_per_key
from renown.plans import oracle as O
from renown.plans.registry import query
from renown.sources import fixtures as X

_EXCL = ", ".join(f"'{s}'" for s in sorted(P.TITLE_DEDUP_EXCLUDED_SOURCES))
_FRAG = ", ".join(f"'{s}'" for s in sorted(P.FRAGMENT_PRESERVING_SOURCES))

# Sequential scan in ord order, written as a recursive CTE that carries the
# kept url keys and kept title keys: the reference's loop, row by row.
_SEQUENTIAL = f"""
keyed AS (
  SELECT ord, target, source, title,
         coalesce(target, '') || chr(1) || nullif({O.sql_canonical_url('url', f'source IN ({_FRAG})')}, '') AS uk,
         CASE WHEN source NOT IN ({_EXCL}) AND {O.sql_canonical_title('title')} <> ''
                   AND {O.sql_strip("lower(coalesce(domain, ''))")} <> ''
              THEN coalesce(target, '') || chr(1) || {O.sql_canonical_title('title')} || chr(1) || {O.sql_strip("lower(coalesce(domain, ''))")}
         END AS tk
  FROM __ROWS__),
numbered AS (SELECT *, row_number() OVER (ORDER BY ord) AS rn FROM keyed),
seq AS (
  SELECT CAST(0 AS BIGINT) AS rn, CAST([] AS VARCHAR[]) AS su, CAST([] AS VARCHAR[]) AS st, false AS keep
  UNION ALL
  SELECT rn,
         CASE WHEN k AND uk IS NOT NULL THEN list_append(su, uk) ELSE su END,
         CASE WHEN k AND tk IS NOT NULL THEN list_append(st, tk) ELSE st END,
         k
  FROM (SELECT n.rn, n.uk, n.tk, s.su, s.st,
               (n.uk IS NULL OR NOT list_contains(s.su, n.uk))
               AND (n.tk IS NULL OR NOT list_contains(s.st, n.tk)) AS k
        FROM seq s JOIN numbered n ON n.rn = s.rn + 1))"""


@query("dedup_first_wins", "WITH RECURSIVE " + O.R_CTE.strip() + "," + _SEQUENTIAL.replace("__ROWS__", "r") + """
SELECT n.ord, n.source, n.title FROM seq s JOIN numbered n ON n.rn = s.rn WHERE s.keep""")
def dedup_first_wins(spark, sf_dir):
    return deduplicate(X.records(spark, sf_dir)).select("ord", "source", "title")


@query("dedup_multi_target", "WITH RECURSIVE " + O.R_CTE.strip() + """,
m AS (SELECT r.* REPLACE (r.ord * 3 + i AS ord, 'Entity ' || CAST((r.ord // 2 + i) % 5 AS VARCHAR) AS target)
      FROM r, unnest([0, 1, 2]) AS copies(i)),""" + _SEQUENTIAL.replace("__ROWS__", "m") + """
SELECT n.ord, n.target, n.source, n.title FROM seq s JOIN numbered n ON n.rn = s.rn WHERE s.keep""")
def dedup_multi_target(spark, sf_dir):
    """The same article landed for several targets stays once per target."""
    return deduplicate(X.shared_records(spark, sf_dir)).select("ord", "target", "source", "title")


@query("dedup_by_link", """
WITH p AS (SELECT page_id, 'Entity ' || CAST(page_id % 3 AS VARCHAR) AS target, split_part(url, '?', 1) AS link
           FROM pages),
f AS (SELECT target, link, min(page_id) AS first_id FROM p WHERE link <> '' GROUP BY target, link)
SELECT p.page_id, p.target, p.link FROM p JOIN f ON f.target = p.target AND f.link = p.link AND f.first_id = p.page_id""")
def dedup_by_link(spark, sf_dir):
    pages = X.table(spark, sf_dir, "pages")
    p = pages.select("page_id",
                     F.concat(F.lit("Entity "), (F.col("page_id") % 3).cast("string")).alias("target"),
                     F.split("url", r"\?").getItem(0).alias("link"))
    return first_per_key(p.where(F.col("link") != ""), ["target", "link"], "page_id")
