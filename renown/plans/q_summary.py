"""Summary queries: the flagship entity reputation and each aggregate alone."""

from __future__ import annotations

from pyspark.sql import functions as F

from renown import params as P
from renown.operators.summary import flat_summary, reputation_summary, source_weight
from renown.plans import oracle as O
from renown.plans.registry import query
from renown.sources import fixtures as X

_SP = P.SummaryParams(as_of=X.AS_OF)


@query("entity_reputation", O.with_r(O.summary_sql("rw")))
def entity_reputation(spark, sf_dir):
    return flat_summary(reputation_summary(X.records(spark, sf_dir), _SP))


def _summary(spark, sf_dir):
    return reputation_summary(X.records(spark, sf_dir), _SP)


@query("source_distribution", O.with_r("""
s AS (SELECT target, source, count(*) AS n, min(ord) AS first_ord FROM r GROUP BY target, source)
SELECT target AS entity,
       string_agg(source || ':' || CAST(n AS VARCHAR), ',' ORDER BY n DESC, first_ord) AS source_distribution
FROM s GROUP BY target"""))
def source_distribution(spark, sf_dir):
    return flat_summary(_summary(spark, sf_dir)).select("entity", "source_distribution")


@query("weighted_sentiment", O.with_r("""
m AS (SELECT target, greatest(-1.0, least(1.0, sum(sentiment * w) / sum(w) FILTER (WHERE sentiment IS NOT NULL))) AS mu
      FROM rw GROUP BY target)
SELECT t.target AS entity,
       CAST(count(t.sentiment) AS BIGINT) AS records_with_sentiment,
       CASE WHEN count(t.sentiment) > 0 THEN round(any_value(m.mu), 6) END AS sentiment_avg,
       CASE WHEN count(t.sentiment) >= 2 THEN
         round(sqrt(sum(t.w * (t.sentiment - m.mu) * (t.sentiment - m.mu)) FILTER (WHERE t.sentiment IS NOT NULL)
                    / sum(t.w) FILTER (WHERE t.sentiment IS NOT NULL)), 6) END AS sentiment_std
FROM rw t JOIN m ON m.target = t.target GROUP BY t.target"""))
def weighted_sentiment(spark, sf_dir):
    return _summary(spark, sf_dir).select("entity", "records_with_sentiment", "sentiment_avg", "sentiment_std")


@query("source_trust", O.with_r(f"""
x AS (SELECT 1)
SELECT target AS entity,
       round(coalesce(avg(w) FILTER (WHERE w >= {P.MIN_SOURCE_TRUST}), avg(w)), 6) AS source_trust_avg
FROM rw GROUP BY target"""))
def source_trust(spark, sf_dir):
    return _summary(spark, sf_dir).select("entity", "source_trust_avg")


@query("recency_score", O.with_r(f"""
x AS (SELECT 1)
SELECT target AS entity,
       round(coalesce(avg(pow(2.0, -greatest(0, {O.AS_OF} - date) / {float(P.RECENCY_HALF_LIFE_DAYS)}))
                      FILTER (WHERE date IS NOT NULL), 0.0), 6) AS recency_score
FROM r GROUP BY target"""))
def recency_score(spark, sf_dir):
    return _summary(spark, sf_dir).select("entity", "recency_score")


@query("volume_score", O.with_r(f"""
x AS (SELECT 1)
SELECT target AS entity, CAST(count(*) AS BIGINT) AS record_count,
       round(ln(1 + count(*)) / (ln(1 + count(*)) + ln(1 + {P.VOLUME_HALFSAT})), 6) AS volume_score
FROM r GROUP BY target"""))
def volume_score(spark, sf_dir):
    return _summary(spark, sf_dir).select("entity", "record_count", "volume_score")


@query("sentiment_trend", O.with_r(f"""
xy AS (
  SELECT target, CAST(count(*) AS BIGINT) AS n, CAST(sum(x) AS HUGEINT) AS sx, sum(sentiment) AS sy,
         sum(x * sentiment) AS sxy, CAST(sum(x * x) AS HUGEINT) AS sxx
  FROM (SELECT target, sentiment, CAST(date - min(date) OVER (PARTITION BY target) AS BIGINT) AS x
        FROM r WHERE date IS NOT NULL AND sentiment IS NOT NULL)
  GROUP BY target),
t AS (SELECT DISTINCT target FROM r)
SELECT t.target AS entity,
       CASE WHEN coalesce(n, 0) < {P.MIN_RECORDS_FOR_TREND} THEN 'unknown'
            WHEN n * sxx - sx * sx = 0 THEN 'stable'
            WHEN (n * sxy - CAST(sx AS DOUBLE) * sy) / CAST(n * sxx - sx * sx AS DOUBLE) > {P.TREND_THRESHOLD} THEN 'up'
            WHEN (n * sxy - CAST(sx AS DOUBLE) * sy) / CAST(n * sxx - sx * sx AS DOUBLE) < -{P.TREND_THRESHOLD} THEN 'down'
            ELSE 'stable' END AS trend
FROM t LEFT JOIN xy ON xy.target = t.target"""))
def sentiment_trend(spark, sf_dir):
    return _summary(spark, sf_dir).select("entity", "trend")


@query("date_range", O.with_r("""
x AS (SELECT 1)
SELECT target AS entity, min(date) AS date_from, max(date) AS date_to FROM r GROUP BY target"""))
def date_range(spark, sf_dir):
    return _summary(spark, sf_dir).select("entity", "date_from", "date_to")


@query("distinct_topics", O.with_r("""
x AS (SELECT 1)
SELECT target AS entity,
       string_agg(DISTINCT query, '|' ORDER BY query) FILTER (WHERE query <> '') AS queries,
       string_agg(DISTINCT topic, '|' ORDER BY topic) FILTER (WHERE topic <> '') AS topics
FROM r GROUP BY target"""))
def distinct_topics(spark, sf_dir):
    return flat_summary(_summary(spark, sf_dir)).select("entity", "queries", "topics")


@query("source_weights", O.with_r("""
x AS (SELECT 1)
SELECT ord, source, w AS weight FROM rw"""))
def source_weights(spark, sf_dir):
    r = X.records(spark, sf_dir)
    return r.select("ord", "source", source_weight(F.col("source")).alias("weight"))
