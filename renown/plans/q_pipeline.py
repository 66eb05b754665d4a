"""Whole-run and sink queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from renown import params as P
from renown.operators.summary import flat_summary, reputation_summary
from renown.plans import oracle as O
from renown.plans.pipeline import run_pipeline
from renown.plans.q_dedup import _EXCL, _FRAG
from renown.plans.q_functions import _sql_clean, sql_language_code
from renown.plans.q_normalize import _ALL_SELECT, _RAW
from renown.plans.registry import ORACLES, query
from renown.session import scratch_path
from renown.sources import fixtures as X
from renown.sources import sinks as SK

SINCE = "2024-03-01"
LANGS = ("en", "de", "fr")
_BLOCKED = "(" + ", ".join(f"'{d}'" for d in sorted(P.BLOCKED_DOMAINS)) + ")"
_WEIGHTS_VALUES = ", ".join(f"('{k}', CAST({v} AS DOUBLE))" for k, v in P.SOURCE_WEIGHTS.items())

def _pipe_sql(since: str, dedup: bool, langs: tuple[str, ...] | None) -> str:
    body = _PIPE_TEMPLATE.replace("__SINCE__", since)
    if not dedup:
        body = body.replace("ded AS (SELECT nb.* FROM seq s JOIN numbered nb ON nb.rn = s.rn WHERE s.keep)",
                            "ded AS (SELECT * FROM q)")
    if langs is None:
        body = body.replace("__LANGFILTER__", "true")
    else:
        body = body.replace("__LANGFILTER__", "language IS NULL OR lower(language) IN ("
                            + ", ".join(f"'{x}'" for x in langs) + ")")
    return body


def stream_summary_sql(since: str) -> str:
    return _pipe_sql(since, dedup=False, langs=None)


_PIPE_TEMPLATE = f"""WITH RECURSIVE {_RAW.strip()},
n AS ({_ALL_SELECT}),
acc AS (SELECT * FROM n WHERE NOT malformed AND url <> ''),
cl AS (SELECT ord, {_sql_clean('source')} AS source, {_sql_clean('query')} AS query,
              {_sql_clean('target')} AS target,
              CASE WHEN starts_with(lower(a.query), lower(a.target || ' '))
                   THEN substring(a.query, length(a.target || ' ') + 1) ELSE a.query END AS topic,
              {_sql_clean('title')} AS title, {O.sql_truncate(_sql_clean('text'))} AS text, date,
              {_sql_clean('url')} AS url, {_sql_clean('domain')} AS domain,
              nullif({_sql_clean('language')}, '') AS language
       FROM acc a),
q AS (SELECT * FROM cl WHERE NOT (coalesce(domain, '') <> '' AND domain IN {_BLOCKED})
        AND (length(coalesce(text, '')) >= {P.MIN_TEXT_LENGTH} OR length(coalesce(title, '')) >= {P.MIN_TITLE_LENGTH})
        AND (date IS NULL OR date >= DATE '__SINCE__')),
keyed AS (
  SELECT *, coalesce(target, '') || chr(1) || nullif({O.sql_canonical_url('url', f'source IN ({_FRAG})')}, '') AS uk,
         CASE WHEN source NOT IN ({_EXCL}) AND {O.sql_canonical_title('title')} <> ''
                   AND {O.sql_strip("lower(coalesce(domain, ''))")} <> ''
              THEN coalesce(target, '') || chr(1) || {O.sql_canonical_title('title')} || chr(1) || {O.sql_strip("lower(coalesce(domain, ''))")} END AS tk
  FROM q),
numbered AS (SELECT *, row_number() OVER (ORDER BY ord) AS rn FROM keyed),
seq AS (
  SELECT CAST(0 AS BIGINT) AS rn, CAST([] AS VARCHAR[]) AS su, CAST([] AS VARCHAR[]) AS st, false AS keep
  UNION ALL
  SELECT rn, CASE WHEN k AND uk IS NOT NULL THEN list_append(su, uk) ELSE su END,
         CASE WHEN k AND tk IS NOT NULL THEN list_append(st, tk) ELSE st END, k
  FROM (SELECT n.rn, n.uk, n.tk, s.su, s.st,
               (n.uk IS NULL OR NOT list_contains(s.su, n.uk)) AND (n.tk IS NULL OR NOT list_contains(s.st, n.tk)) AS k
        FROM seq s JOIN numbered n ON n.rn = s.rn + 1)),
ded AS (SELECT nb.* FROM seq s JOIN numbered nb ON nb.rn = s.rn WHERE s.keep),
en AS (SELECT ord, source, query, target, topic, date, CAST(NULL AS DOUBLE) AS sentiment,
              {sql_language_code('language')} AS language FROM ded),
lf AS (SELECT * FROM en WHERE __LANGFILTER__),
rw AS (SELECT lf.*, COALESCE(sw.w, CAST(0.5 AS DOUBLE)) AS w
       FROM lf LEFT JOIN (VALUES {_WEIGHTS_VALUES}) AS sw(source, w) ON sw.source = lf.source),
{O.summary_sql('rw')}"""


@query("pipeline_summary", _pipe_sql(SINCE, dedup=True, langs=LANGS))
def pipeline_summary(spark, sf_dir):
    """Whole batch run over the landed payloads (no sentiment model) -> summary per entity."""
    res = run_pipeline(X.landed_raw(spark, sf_dir), since=SINCE, languages=LANGS, as_of=X.AS_OF)
    return flat_summary(res.summary)


@query("sink_roundtrip_csv", O.with_r("""
x AS (SELECT 1)
SELECT nullif(source, '') AS source, nullif(query, '') AS query, nullif(topic, '') AS topic,
       nullif(target, '') AS target, nullif(title, '') AS title, nullif(text, '') AS text,
       strftime(date, '%Y-%m-%d') AS date, nullif(url, '') AS url, nullif(author, '') AS author,
       nullif(language, '') AS language, nullif(domain, '') AS domain, retrieved_at,
       views_count, likes_count, comments_count, sentiment
FROM r"""))
def sink_roundtrip_csv(spark, sf_dir):
    """Records written as CSV (header, quoted multi-line text) and read back."""
    path = scratch_path(spark, "records-csv")
    SK.write_records_csv(X.records(spark, sf_dir), path)
    return SK.read_records_csv(spark, path)


@query("sink_roundtrip_json", O.with_r("""
x AS (SELECT 1)
SELECT source, query, topic, target, title, text, strftime(date, '%Y-%m-%d') AS date, url, author, language,
       domain, retrieved_at, views_count, likes_count, comments_count, sentiment
FROM r"""))
def sink_roundtrip_json(spark, sf_dir):
    """Records written as JSON lines (explicit nulls) and read back."""
    path = scratch_path(spark, "records-json")
    SK.write_records_json(X.records(spark, sf_dir), path)
    return SK.read_records_json(spark, path)


@query("retention", """
SELECT event_id, CAST(ts AS DATE) AS ingest_date FROM events
WHERE CAST(ts AS DATE) >= DATE '2024-01-31' - INTERVAL 14 DAY""")
def retention(spark, sf_dir):
    """Landing rows kept by a 14-day retention window as of 2024-01-31 (ingest day = event day)."""
    ev = X.table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("ingest_date"))
    return SK.retained(ev, "2024-01-31", 14)


_STEPS = _pipe_sql(SINCE, dedup=True, langs=LANGS).split("rw AS (SELECT lf.*")[0].rstrip().rstrip(",")
_QUALITY = _STEPS.split("q AS (SELECT * FROM cl WHERE ")[1].split("AND (date IS NULL")[0]


@query("run_counts", f"""{_STEPS}
SELECT 'normalized' AS step, count(*) AS n FROM acc
UNION ALL SELECT 'after_quality', count(*) FROM cl WHERE {_QUALITY}
UNION ALL SELECT 'after_since', count(*) FROM q
UNION ALL SELECT 'after_dedup', count(*) FROM ded
UNION ALL SELECT 'enriched', count(*) FROM en
UNION ALL SELECT 'with_language', count(language) FROM en
UNION ALL SELECT 'with_sentiment', count(sentiment) FROM en
UNION ALL SELECT 'after_language', count(*) FROM lf""")
def run_counts(spark, sf_dir):
    """Rows after each step of the whole run, counted beside its writes."""
    res = run_pipeline(X.landed_raw(spark, sf_dir), since=SINCE, languages=LANGS, as_of=X.AS_OF)
    return spark.createDataFrame(list(res.counts().items()), "step string, n long")


@query("raw_landing", f"""WITH {_RAW.strip()}
SELECT ord, source, query, target, DATE '2024-03-01' AS ingest_date FROM raw WHERE ord % 2 = 1""")
def raw_landing(spark, sf_dir):
    """Payloads landed on two days, after a purge that keeps 30 days as of 2024-03-10."""
    path, raw = scratch_path(spark, "raw-landing"), X.landed_raw(spark, sf_dir)
    SK.write_raw(raw.where("ord % 2 = 0"), path, ingest_date="2024-01-01")
    SK.write_raw(raw.where("ord % 2 = 1"), path, ingest_date="2024-03-01")
    SK.purge_raw(spark, path, as_of="2024-03-10", days=30)
    return spark.read.parquet(path).select("ord", "source", "query", "target", "ingest_date")


_NUMBERS = ("record_count, records_with_sentiment, sentiment_avg, sentiment_std, source_trust_avg, recency_score, "
            "volume_score, reputation_score")


@query("summary_sink", f"""SELECT entity, {_NUMBERS}, trend, strftime(date_from, '%Y-%m-%d') AS date_from,
  strftime(date_to, '%Y-%m-%d') AS date_to FROM ({O.with_r(O.summary_sql("rw"))})""")
def summary_sink(spark, sf_dir):
    """Summaries written as JSON and read back."""
    path = scratch_path(spark, "summary-json")
    SK.write_summary_json(reputation_summary(X.records(spark, sf_dir), P.SummaryParams(as_of=X.AS_OF)), path)
    fields = [f"{f.strip()} {'long' if 'record' in f else 'double'}" for f in _NUMBERS.split(",")]
    back = spark.read.schema(", ".join(["entity string", *fields, "trend string",
                                        "date_range struct<from: string, to: string>"])).json(path)
    return back.withColumns({"date_from": F.col("date_range.from"), "date_to": F.col("date_range.to")}).drop("date_range")


@query("sinks_isolated", ORACLES["sink_roundtrip_csv"])
def sinks_isolated(spark, sf_dir):
    """Records written by a sink that runs after one that fails (its folder exists already)."""
    one, two = scratch_path(spark, "records-json"), scratch_path(spark, "records-csv")
    done = SK.run_sinks(X.records(spark, sf_dir), {
        "json": lambda df: SK.write_records_json(df, one),
        "taken": lambda df: SK.write_records_json(df, one, mode="error"),
        "csv": lambda df: SK.write_records_csv(df, two)})
    if [name for name, error in done.items() if error] != ["taken"]:
        raise RuntimeError(f"unexpected sink results: {done}")
    return SK.read_records_csv(spark, two)
