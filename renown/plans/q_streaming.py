"""Streaming queries: landed payloads -> streaming ingest -> incremental summary."""

from __future__ import annotations

from renown.operators.summary import flat_summary
from renown.plans.q_pipeline import stream_summary_sql
from renown.plans.registry import query
from renown.session import scratch_path
from renown.sources import fixtures as X
from renown.streaming import ingest as ST

SINCE = "2024-03-01"


@query("stream_summary", stream_summary_sql(SINCE))
def stream_summary(spark, sf_dir):
    """Land the payload fixture, stream it through ingest in two batches, keep the summary incrementally."""
    landing = scratch_path(spark, "landing")
    X.landed_raw(spark, sf_dir).write.parquet(landing)
    files = len(spark.read.schema(ST.RAW_SCHEMA).parquet(landing).inputFiles())
    out, ck = scratch_path(spark, "summary"), scratch_path(spark, "summary-ck")
    recs = ST.records_stream(ST.read_raw_stream(spark, landing, max_files_per_trigger=-(-files // 2)), SINCE)
    q = ST.start_summary(recs, out, ck, X_SP)
    q.awaitTermination()
    return flat_summary(spark.read.parquet(out))


from renown import params as _P  # noqa: E402

X_SP = _P.SummaryParams(as_of=X.AS_OF)
