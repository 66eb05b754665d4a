"""Talk-page section query: header split, wikitext cleaning, section predicate."""

from __future__ import annotations

from pyspark.sql import functions as F

from renown.plans import oracle as O
from renown.plans.registry import query
from renown.sources import fixtures as X
from renown.sources import landed as L

MAX_SECTIONS = 1_000_000  # more than any page has


def _talk_pages(spark, sf_dir):
    """One talk page per document: each text line becomes a section with markup."""
    docs = X.table(spark, sf_dir, "documents")
    lines = F.split(F.col("text"), "\n")
    body = F.transform(lines, lambda ln, i: F.concat(
        F.lit("== Section "), (i + 1).cast("string"), F.lit(" ==\n"),
        F.when(i % 3 == 0, F.lit("{{cite|x={{inner}}}} ")).otherwise(F.lit("")),
        ln, F.lit(" [[Page|label]] '''bold''' ~~~~")))
    meta = F.transform(lines, lambda ln, i: F.struct(
        F.concat(F.lit("Section "), (i + 1).cast("string")).alias("line"), F.lit(2).alias("level"),
        F.concat(F.lit("Section_"), (i + 1).cast("string")).alias("anchor"),
        (i + 1).cast("string").alias("index")))
    return docs.select(F.col("doc_id"), F.concat(F.lit("Page "), F.col("doc_id").cast("string")).alias("page_title"),
                       F.col("lang"), F.concat(F.lit("intro\n"), F.array_join(body, "\n")).alias("wikitext"),
                       meta.alias("sections"))


def _sql_clean_wikitext(x: str) -> str:
    ws = O.WS
    t = f"regexp_replace({x}, '~{{3,5}}', '', 'g')"
    # templates: the fixture nests at most two deep, so two innermost-first passes suffice
    tmpl = r"\{\{[^{}]*\}\}"
    t = f"regexp_replace(regexp_replace({t}, '{tmpl}', '', 'g'), '{tmpl}', '', 'g')"
    t = f"regexp_replace({t}, '{r'(?i)<ref\b[^>]*/\s*>'}', '', 'g')"
    t = f"regexp_replace({t}, '{r'(?is)<ref\b[^>]*>.*?</ref\s*>'}', '', 'g')"
    t = f"regexp_replace({t}, '<[^>]+>', '', 'g')"
    t = f"regexp_replace({t}, '{r'\[\[[^|\]]*\|([^\]]+)\]\]'}', '{r'\1'}', 'g')"
    t = f"regexp_replace({t}, '{r'\[\[([^\]]+)\]\]'}', '{r'\1'}', 'g')"
    link = r"\[https?://[^" + O.PY_WS + r"]+" + ws + r"+([^\]]+)\]"
    t = f"regexp_replace({t}, '{link}', '{r'\1'}', 'g')"
    t = f"regexp_replace({t}, '''''{{2,3}}', '', 'g')"
    t = f"regexp_replace({t}, '(?m)^={{2,}}.+?={{2,}}{ws}*$', '', 'g')"
    t = f"regexp_replace({t}, '(?m)^[:*#]+{ws}?', '', 'g')"
    t = f"regexp_replace({t}, '{r'\n{3,}'}', chr(10) || chr(10), 'g')"
    return O.sql_strip(t)


_HEADER = r"(?m)^==" + O.WS + r"*(.+?)" + O.WS + r"*==" + O.WS + r"*$"
_TEMPLATE_ONLY = r"(?s)^[\s]*\{\{[^}]+\}\}[\s]*$"

_TALK_SQL = f"""
WITH d AS (SELECT doc_id, lang, string_split(text, chr(10)) AS lines FROM documents),
w AS (SELECT doc_id, lang, len(lines) AS n,
             'intro' || chr(10) || array_to_string(list_transform(lines, lambda ln, i:
                '== Section ' || CAST(i AS VARCHAR) || ' ==' || chr(10)
                || CASE WHEN (i - 1) % 3 = 0 THEN '{{{{cite|x={{{{inner}}}}}}}} ' ELSE '' END
                || ln || ' [[Page|label]] ''''''bold'''''' ~~~~'), chr(10)) AS wikitext FROM d),
b AS (SELECT doc_id, lang, n, regexp_split_to_array(wikitext, '{_HEADER}') AS bodies FROM w),
s AS (SELECT doc_id, lang, i, {O.sql_strip("coalesce(bodies[i + 1], '')")} AS raw
      FROM b, LATERAL (SELECT unnest(range(1, n + 1)) AS i)),
c AS (SELECT doc_id, lang, i, raw, {_sql_clean_wikitext('raw')} AS clean FROM s),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS kn FROM c
      WHERE length(clean) >= 50 AND NOT regexp_matches(raw, '{_TEMPLATE_ONLY}'))
SELECT doc_id, CAST(i AS VARCHAR) AS section_index, 'Section ' || CAST(i AS VARCHAR) AS section_title,
       'https://' || lang || '.wikipedia.org/wiki/Talk:Page_' || CAST(doc_id AS VARCHAR)
         || '#Section_' || CAST(i AS VARCHAR) AS url,
       CAST(length(clean) AS INTEGER) AS n_chars
FROM k WHERE kn <= {MAX_SECTIONS}"""


@query("talk_sections", _TALK_SQL)
def talk_sections(spark, sf_dir):
    """Talk pages built from the documents, split into kept, cleaned sections."""
    secs = L.talk_sections(_talk_pages(spark, sf_dir), max_results=MAX_SECTIONS)
    return secs.select("doc_id", "section_index", "section_title", "url", F.length("wikitext").alias("n_chars"))
