"""Enrichment queries: language detection, sentiment, and the SQL-checkable gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from renown import params as P
from renown.operators import enrich as EN
from renown.plans import oracle as O
from renown.plans.q_functions import sql_language_code
from renown.plans.registry import query
from renown.session import discard, materialize
from renown.sources import fixtures as X


FOLDS = 3


def _held_out():
    return F.col("doc_id") % 5 == 0


def _lang_model(spark, sf_dir):
    docs = X.table(spark, sf_dir, "documents").where(~_held_out())
    return EN.fit_language_model(X.spread(docs.select("text", "lang")))


def _fold(name: str):
    return F.pmod(F.col(name), F.lit(FOLDS)).cast("int")


def _sent_model(spark, sf_dir):
    """One model for each fold of the document number, fitted on the labelled rows of the others."""
    rows = EN.sentiment_labels(X.table(spark, sf_dir, "labels"), X.table(spark, sf_dir, "documents"))
    return EN.fit_folded_scorer(rows.withColumn("fold", _fold("doc_id")), FOLDS, apply_fold=lambda: _fold("ord"))


_GRAMS = f"""docs AS (SELECT doc_id, lang, doc_id % 5 = 0 AS held_out, length(text) AS chars,
    list_transform(string_split(lower(text), ''), lambda c: CASE WHEN c = '' THEN 0 ELSE unicode(c) END) AS a FROM documents),
grams AS (SELECT doc_id, lang, held_out, unnest(list_transform(range(1, len(a) - 1), lambda i:
    (a[i] * 961 + a[i + 1] * 31 + a[i + 2]) % {EN.GRAM_BUCKETS})) AS g FROM docs),
counted AS (SELECT lang, g, count(*) AS n FROM grams WHERE NOT held_out AND lang IS NOT NULL GROUP BY ALL),
totals AS (SELECT l.lang, coalesce(sum(n), 0) + {EN.GRAM_BUCKETS} AS total,
    ln((SELECT count(*) FROM docs d WHERE d.lang = l.lang AND NOT held_out)
       / (SELECT count(*) FROM docs d WHERE d.lang IS NOT NULL AND NOT held_out)) AS prior
  FROM (SELECT DISTINCT lang FROM docs WHERE NOT held_out AND lang IS NOT NULL) l LEFT JOIN counted c ON c.lang = l.lang GROUP BY ALL),
mine AS (SELECT doc_id, g, count(*) AS k FROM grams GROUP BY ALL),
scores AS (SELECT m.doc_id, t.lang, any_value(t.prior) + sum(k * ln((coalesce(c.n, 0) + 1) / t.total)) AS s
  FROM mine m CROSS JOIN totals t LEFT JOIN counted c ON c.lang = t.lang AND c.g = m.g GROUP BY ALL),
best AS (SELECT doc_id, arg_max(lang, s) AS label, 1 / sum(exp(s - top)) AS p
  FROM (SELECT *, max(s) OVER (PARTITION BY doc_id) AS top FROM scores) GROUP BY doc_id)"""


@query("detect_language", f"""WITH {_GRAMS}
SELECT d.doc_id, d.lang, d.held_out, CASE WHEN chars >= {P.NLP_MIN_LEN_DETECT} AND p >= {P.NLP_LANG_DETECT_MIN_CONFIDENCE}
  THEN {sql_language_code('label')} END AS detected_language
FROM docs d LEFT JOIN best b ON b.doc_id = d.doc_id""")
def detect_language(spark, sf_dir):
    """Detected language of every document (counted on the rows that are not held out)."""
    docs = X.spread(X.table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    lang = _lang_model(spark, sf_dir)
    return lang.predict(docs, "text").select(
        "doc_id", "lang", _held_out().alias("held_out"), "detected_language")


@query("sentiment_score")
def sentiment_score(spark, sf_dir):
    """Language and out-of-fold sentiment of every fixture record, with the label where there is one.

    No row is scored by a model that was fitted on it; ``agrees`` compares the sign with the label's class.
    """
    lang, sent = _lang_model(spark, sf_dir), _sent_model(spark, sf_dir)
    known = EN.sentiment_labels(X.table(spark, sf_dir, "labels"), X.table(spark, sf_dir, "documents"))
    scored = EN.enrich(X.records(spark, sf_dir), lang, sent)
    agrees = F.when(F.col("label") == "neutral", F.abs("sentiment") < 0.5) \
              .otherwise((F.col("sentiment") > 0) == (F.col("label") == "positive"))
    return scored.join(known.select(F.col("doc_id").alias("ord"), "label"), "ord", "left").select(
        "ord", "language", "sentiment", "label", agrees.alias("agrees"))


_S = O.sql_strip
_SUP = ", ".join(f"'{x}'" for x in sorted(P.SENTIMENT_SUPPORTED_LANGS))


@query("enrich_gates", O.with_r(f"""
a AS (SELECT ord, concat_ws(' ', nullif({_S('title')}, ''), nullif({_S('text')}, '')) AS atext,
             {sql_language_code('language')} AS declared FROM r)
SELECT ord, CAST(length(atext) AS BIGINT) AS analysis_len, declared,
       length(atext) >= {P.NLP_MIN_LEN_DETECT} AND declared IS NULL AS needs_detection,
       length(atext) >= {P.NLP_MIN_LEN_SENTIMENT} AND (declared IS NULL OR declared IN ({_SUP})) AS sentiment_eligible
FROM a"""))
def enrich_gates(spark, sf_dir):
    r = X.records(spark, sf_dir)
    from renown.functions.text import language_code
    a = r.select("ord", EN.analysis_text().alias("atext"), language_code("language").alias("declared"))
    return a.select(
        "ord", F.length("atext").cast("bigint").alias("analysis_len"), "declared",
        EN.needs_detection(F.col("atext"), F.col("declared")).alias("needs_detection"),
        EN.sentiment_eligible(F.col("atext"), F.col("declared")).alias("sentiment_eligible"))


_LANGUAGE = EN.WordListLanguage({"en": frozenset({"the", "of", "and"}), "fr": frozenset({"des", "et", "le"}),
                                 "de": frozenset({"der", "die", "und"}), "es": frozenset({"que", "el", "los"})})
_SCORER = EN.LexiconScorer(frozenset({"with", "for", "this", "new", "good"}), frozenset({"was", "not", "but", "no", "bad"}))


def _sql_hits(words) -> str:
    return f"len(list_filter(ws, lambda x: x IN ({', '.join(repr(w) for w in sorted(words))})))"


_HITS = ", ".join(f"{_sql_hits(words)} AS h_{label}" for label, words in _LANGUAGE.words.items())
_MOST = f"greatest({', '.join('h_' + label for label in _LANGUAGE.words)})"
_BEST = " ".join(f"WHEN h_{label} = {_MOST} THEN '{label}'" for label in _LANGUAGE.words)
_PLUGGED = f"""
a AS (SELECT ord, concat_ws(' ', nullif({_S('title')}, ''), nullif({_S('text')}, '')) AS atext,
             {sql_language_code('language')} AS declared FROM r),
w AS (SELECT *, string_split_regex(lower(atext), '[^a-z]+') AS ws FROM a),
h AS (SELECT *, {_HITS}, {_sql_hits(_SCORER.positive)} AS pos, {_sql_hits(_SCORER.negative)} AS neg FROM w),
l AS (SELECT *, coalesce(declared, CASE WHEN length(atext) < {P.NLP_MIN_LEN_DETECT} OR {_MOST} = 0 THEN NULL {_BEST} END) AS language
      FROM h),
enriched AS (SELECT ord, language, CASE WHEN length(atext) >= {P.NLP_MIN_LEN_SENTIMENT} AND (language IS NULL OR language IN ({_SUP}))
      THEN round(pos / greatest(pos + neg, 1) - neg / greatest(pos + neg, 1), 6) END AS sentiment FROM l)"""


@query("enrich_plugged", O.with_r(_PLUGGED + "\nSELECT * FROM enriched"))
def enrich_plugged(spark, sf_dir):
    """Every record enriched with a language model and a scorer of the caller's own (word lists)."""
    return EN.enrich(X.records(spark, sf_dir), _LANGUAGE, _SCORER).select("ord", "language", "sentiment")


@query("enrich_coverage", O.with_r(_PLUGGED + """
SELECT count(*) AS rows, count(language) AS with_language, count(sentiment) AS with_sentiment FROM enriched"""))
def enrich_coverage(spark, sf_dir):
    """Coverage counters of one enrichment, counted beside the write of its rows."""
    out, seen = EN.enrich(X.records(spark, sf_dir), _LANGUAGE, _SCORER, observe=True)
    discard(materialize(out, "enriched"))
    return spark.createDataFrame([seen.get], "rows long, with_language long, with_sentiment long")
