"""Plan shapes that the scale design depends on (checked with explain output)."""

from pyspark.sql import functions as F

from renown import params as P
from renown.operators.normalize import accepted, normalize
from renown.operators.summary import reputation_summary
from renown.sources import fixtures as X

SF = "/root/testdata/sf0.001"


def _physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_summary_shuffles_twice_and_prunes_columns(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        recs = spark.range(1000).select(
            (F.col("id") % 3).cast("string").alias("target"), (F.col("id") % 5).cast("string").alias("source"),
            F.col("id").alias("ord"), F.lit("q").alias("query"), F.lit("t").alias("topic"),
            (F.col("id") % 3 - 1).cast("double").alias("sentiment"),
            F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 30).cast("int")).alias("date"))
        plan = _physical(reputation_summary(recs, P.SummaryParams()))
        # one exchange on (target, source) after partial aggregation, one on target; the same two for the
        # distinct queries and topics
        assert plan.count("Exchange hashpartitioning") == 4
        assert "Exchange hashpartitioning(target" in plan
        flagship = X.records(spark, SF)
        scan = _physical(reputation_summary(flagship, P.SummaryParams()))
        # the documents scan reads two columns, never the text
        assert "ReadSchema: struct<doc_id:bigint,source:string>" in scan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_reject_filter_stays_above_normalisation(spark):
    raw = X.landed_raw(spark, SF)
    plain = len(normalize(raw)._jdf.queryExecution().optimizedPlan().toString())
    filtered = len(accepted(normalize(raw))._jdf.queryExecution().optimizedPlan().toString())
    # the predicate must not be copied into the per-source expressions
    assert filtered < plain * 1.5
