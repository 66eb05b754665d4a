"""Sinks: raw landing store, record exports (JSON/CSV), summary export.

Writes are distributed (one file per task); paths are directories on the
shared file system.  Each sink is independent: ``run_sinks`` persists the
input once and isolates failures so one broken sink does not stop the
others.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renown import params as P
from renown.session import materialize

log = logging.getLogger(__name__)


def export_projection(records: DataFrame) -> DataFrame:
    """The 16 exported fields in canonical order; dates as yyyy-MM-dd text."""
    cols = []
    for c in P.EXPORT_FIELDS:
        if c == "date":
            cols.append(F.date_format("date", "yyyy-MM-dd").alias("date"))
        elif c in records.columns:
            cols.append(F.col(c))
        else:
            cols.append(F.lit(None).alias(c))
    return records.select(*cols)


def record_json(records: DataFrame) -> DataFrame:
    """One JSON text per record with explicit nulls (non-ASCII kept)."""
    proj = export_projection(records)
    return proj.select(F.to_json(F.struct(*proj.columns), {"ignoreNullFields": "false"}).alias("json"))


def _export(records: DataFrame, ordered: bool) -> DataFrame:
    """Export projection; ``ordered`` sorts by ``ord`` (range-partitioned, files in order)."""
    if ordered and "ord" in records.columns:
        return export_projection(records.orderBy("ord"))
    return export_projection(records)


def write_records_json(records: DataFrame, path: str, mode: str = "overwrite", ordered: bool = False) -> None:
    _export(records, ordered).write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_records_csv(records: DataFrame, path: str, mode: str = "overwrite", ordered: bool = False) -> None:
    """Header, canonical order, NULL and '' both written empty; text may hold newlines."""
    (_export(records, ordered).write.mode(mode)
     .option("header", True).option("escape", '"').option("nullValue", "").option("emptyValue", "")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def read_records_csv(spark: SparkSession, path: str) -> DataFrame:
    schema = ", ".join(f"{c} {'bigint' if c.endswith('_count') else 'double' if c == 'sentiment' else 'string'}"
                       for c in P.EXPORT_FIELDS)
    return (spark.read.schema(schema).option("header", True).option("multiLine", True)
            .option("escape", '"').option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False).csv(path))


def read_records_json(spark: SparkSession, path: str) -> DataFrame:
    schema = ", ".join(f"{c} {'bigint' if c.endswith('_count') else 'double' if c == 'sentiment' else 'string'}"
                       for c in P.EXPORT_FIELDS)
    return spark.read.schema(schema).json(path)


def summary_for_export(summary: DataFrame) -> DataFrame:
    """Summary rows shaped like the reference's JSON (ordered source map, date_range object)."""
    return summary.select(
        "entity", "queries", "topics", "record_count", "records_with_sentiment",
        F.map_from_entries(F.transform("source_distribution",
                                       lambda e: F.struct(e["source"], e["count"]))).alias("source_distribution"),
        "sentiment_avg", "sentiment_std", "source_trust_avg", "recency_score", "volume_score",
        "reputation_score", "trend",
        F.when(F.col("date_from").isNotNull(), F.struct(
            F.date_format("date_from", "yyyy-MM-dd").alias("from"),
            F.date_format("date_to", "yyyy-MM-dd").alias("to"))).alias("date_range"),
        "computed_at")


def write_summary_json(summary: DataFrame, path: str, mode: str = "overwrite") -> None:
    summary_for_export(summary).write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_raw(raw: DataFrame, path: str, ingest_date: str | None = None) -> None:
    """Append raw rows, partitioned by source and ingest day (immutable landing)."""
    day = ingest_date or dt.date.today().isoformat()
    (raw.withColumn("ingest_date", F.lit(day).cast("date"))
     .write.mode("append").partitionBy("source", "ingest_date").parquet(path))


def retained(raw: DataFrame, as_of: str, days: int) -> DataFrame:
    """Raw rows still inside the retention window (ingest_date >= as_of - days)."""
    if days < 1:
        raise ValueError("retention days must be >= 1")
    return raw.where(F.col("ingest_date") >= F.date_sub(F.lit(as_of).cast("date"), days))


def purge_raw(spark: SparkSession, path: str, as_of: str, days: int) -> list[str]:
    """Delete ``ingest_date`` partitions older than the window; returns removed paths.

    Works on partition directories through the Hadoop FileSystem API, so the
    driver touches #sources x #days paths, never the data.
    """
    if days < 1:
        raise ValueError("retention days must be >= 1")
    cutoff = dt.date.fromisoformat(as_of) - dt.timedelta(days=days)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    removed = []
    if not fs.exists(root):
        return removed
    for src in fs.listStatus(root):
        if not src.isDirectory() or not src.getPath().getName().startswith("source="):
            continue
        for part in fs.listStatus(src.getPath()):
            name = part.getPath().getName()
            if not name.startswith("ingest_date="):
                continue
            try:
                day = dt.date.fromisoformat(name.split("=", 1)[1])
            except ValueError:
                continue
            if day < cutoff:
                fs.delete(part.getPath(), True)
                removed.append(part.getPath().toString())
    return removed


def run_sinks(df: DataFrame, sinks: dict[str, Callable[[DataFrame], None]]) -> dict[str, str | None]:
    """Run every sink on one persisted input; a failing sink is logged, the others run.

    Returns sink name -> None on success or the error text.
    """
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    result: dict[str, str | None] = {}
    try:
        for name, sink in sinks.items():
            try:
                sink(df)
                result[name] = None
            except Exception as exc:  # noqa: BLE001 - isolation is the point
                log.error("sink %s failed: %s", name, exc)
                result[name] = str(exc)
    finally:
        df.unpersist()
    return result


SAVED_RAW_SCHEMA = "source STRING, query STRING, target STRING, retrieved_at STRING, payload STRING"
#: Ranges that values are sorted into to number them: bounds what the driver adds up.
RANK_RANGES = 1000


def ranked(values: DataFrame, col: str, out: str) -> DataFrame:
    """Distinct ``values`` with ``out``, their 1-based rank by ``col``.

    A range sort is written; the sizes of the ranges before (one number a
    range, at most ``RANK_RANGES``) are added to the place in the range, so nothing
    is ranked in one task.
    """
    spark = values.sparkSession
    parts = min(RANK_RANGES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = materialize(values.select(col).distinct().repartitionByRange(parts, col).sortWithinPartitions(col)
                         .withColumn("_mid", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_mid", 33)
    sizes = {r.part: r.n for r in placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before, starts = 0, []
    for i in range(max(sizes, default=-1) + 1):
        starts.append(before)
        before += sizes.get(i, 0)
    start = F.get(F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>"), part)
    return placed.select(col, (start + F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias(out))


def read_saved_raw(spark: SparkSession, path: str) -> DataFrame:
    """Saved runs written as JSON arrays of raw records -> raw rows.

    ``payload`` is declared as a string, so each payload object is kept as
    its JSON text for ``normalize``.  ``ord`` = (file rank, position in
    file): the distinct file names are ranked by a range sort, and the
    position comes from the row index within the reading task, counted from
    the file's first row (a multi-line JSON file is never split).
    """
    df = spark.read.schema(SAVED_RAW_SCHEMA).option("multiLine", True).json(path)
    df = df.withColumn("_file", F.input_file_name()).withColumn("_mid", F.monotonically_increasing_id())
    files = materialize(df.groupBy("_file").agg(F.min("_mid").alias("_first")), "saved-files")
    files = files.join(ranked(files, "_file", "_frank"), "_file")
    return (df.join(files, "_file")
            .withColumn("ord", F.shiftleft("_frank", 33) + F.col("_mid") - F.col("_first"))
            .drop("_file", "_mid", "_first", "_frank"))
