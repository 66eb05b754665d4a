"""Structured Streaming: incremental ingestion and an incremental summary.

The per-row stages (normalize, clean, quality, since) are stateless
``DataFrame -> DataFrame`` functions, so they run unchanged on a
``readStream`` of the raw landing table.  First-wins dedup is a global
order-dependent rule and stays a batch job over the ingested records.

The incremental summary keeps, as streaming state, the (target, source)
partial aggregates (bounded by #targets x #sources) and a row for each distinct
query and topic of a target; every micro-batch finishes the per-entity summary from that
state with the same code as the batch summary.  Without dedup it counts
duplicates, as the reference would without its dedup step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from renown import params as P
from renown.operators.clean import clean_records
from renown.operators.enrich import LanguageModel, Scorer, enrich
from renown.operators.filters import filter_by_date, filter_quality
from renown.operators.normalize import accepted, normalize
from renown.operators.summary import keyed_stats, summary_from_stats
from renown.session import small_batches

RAW_SCHEMA = "ord BIGINT, source STRING, query STRING, target STRING, retrieved_at STRING, payload STRING"


def read_raw_stream(spark: SparkSession, landing_path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(RAW_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(landing_path)


def records_stream(raw_stream: DataFrame, since: str | None = None,
                   language_model: LanguageModel | None = None, scorer: Scorer | None = None) -> DataFrame:
    """Landed raw stream -> cleaned, filtered, enriched records (no dedup)."""
    recs = filter_by_date(filter_quality(clean_records(accepted(normalize(raw_stream)))), since)
    if "sentiment" not in recs.columns:
        from pyspark.sql import functions as F
        recs = recs.withColumn("sentiment", F.lit(None).cast("double"))
    return enrich(recs, language_model, scorer)


def start_ingest(records: DataFrame, out_path: str, checkpoint_location: str,
                 available_now: bool = True) -> StreamingQuery:
    """Append records to a parquet table; exactly-once via the checkpoint location."""
    w = (records.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint_location))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    with small_batches(records.sparkSession):  # a query keeps the settings of its start
        return w.start(out_path)


def start_summary(records: DataFrame, out_path: str, checkpoint_location: str,
                  sp: P.SummaryParams | None = None, available_now: bool = True) -> StreamingQuery:
    """Maintain the per-entity summary table from streaming (target, source) state."""
    sp = sp or P.SummaryParams()
    stats = keyed_stats(records, sp)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        batch.persist()
        try:
            own = batch.where("kind = 's'").drop("kind", "value")
            summary_from_stats(own, batch.where("kind <> 's'").select("target", "kind", "value"), sp) \
                .write.mode("overwrite").parquet(out_path)
        finally:
            batch.unpersist()

    w = (stats.writeStream.outputMode("complete").foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint_location))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    with small_batches(records.sparkSession):  # a query keeps the settings of its start
        return w.start()
