"""What keeps time and memory of growing tables in bounds: rows dealt out to all cores, small batches for Python."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from renown.functions import text as TX
from renown.plans import q_streaming
from renown.plans.q_functions import query_helpers
from renown.sources import fixtures as X
from renown.sources import mixed as M
from renown.streaming import ingest as ST

BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def plain(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def _pages(spark, path):
    spark.range(200).select(F.col("id").alias("page_id"), F.concat(F.lit("https://a.example/"), F.col("id")).alias("url"),
                            F.lit('<html lang="en"><title>A long title</title><body><p>Some words of a page</p></body></html>')
                            .alias("html")).coalesce(1).write.parquet(f"{path}/pages.parquet")


def test_query_helpers_deals_one_row_group_out(plain, tmp_path):
    plain.range(200).select(F.col("id").alias("doc_id"), F.lit("Some Title, of words").alias("text")) \
         .coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    out = query_helpers(plain, str(tmp_path))
    assert out.rdd.getNumPartitions() == int(plain.conf.get("spark.sql.shuffle.partitions"))
    assert out.select("slug", "hashtag", "gdelt_query").distinct().collect() == [("some_title_of_words", "SomeTitleOfWords", "Some Title, words")]


def test_landing_of_the_stream_is_written_by_more_than_two_tasks(plain, tmp_path, monkeypatch):
    _pages(plain, tmp_path)
    seen, batches = [], []
    read, start = ST.read_raw_stream, ST.start_summary

    def reading(spark, path, max_files_per_trigger=None):
        seen.append((len(spark.read.parquet(path).inputFiles()), max_files_per_trigger))
        return read(spark, path, max_files_per_trigger)

    def starting(*args):
        q = start(*args)
        q.awaitTermination()
        batches.extend(p["numInputRows"] for p in q.recentProgress)
        return q

    monkeypatch.setattr(ST, "read_raw_stream", reading)
    monkeypatch.setattr(ST, "start_summary", starting)
    assert q_streaming.stream_summary(plain, str(tmp_path)).count() == 5
    (files, at_once), = seen
    assert files > 2 and at_once == -(-files // 2)
    assert len([n for n in batches if n]) == 2 and sum(batches) == 200


def test_templates_leave_arrow_a_few_at_a_time(monkeypatch):
    seen = []
    own = TX._outside_templates
    monkeypatch.setattr(TX, "_outside_templates", lambda t: seen.append(t) or own(t))
    rows = [["plain", "a {{b {{c}} d}} e", None], None, [], ["}} stays", "{{open"]] * 300
    arr = pa.array(rows, pa.list_(pa.string()))
    want = [["plain", "a  e", None], None, [], ["}} stays", ""]] * 300
    assert TX._all_outside_templates.func(arr).to_pylist() == want
    assert TX._all_outside_templates.func(arr.slice(2, 5)).to_pylist() == want[2:7]
    assert set(seen) == {"a {{b {{c}} d}} e", "{{open"}


def test_talk_sections_reach_python_in_small_batches(spark, monkeypatch):
    seen, write = {}, M.materialize
    before = spark.conf.get(BATCH)
    monkeypatch.setattr(M, "materialize", lambda df, name: seen.update({name: spark.conf.get(BATCH)}) or write(df, name))
    body = "== One ==\n{{t}} " + "long enough words of a section " * 3
    pages = spark.createDataFrame(
        [("wikitalk", "q", "E", "2024", "en", "P", [("One", 2, None, "1")], body)],
        "source string, query string, target string, retrieved_at string, lang string, page_title string, "
        "sections array<struct<line:string,level:int,anchor:string,index:string>>, wikitext string")
    assert M.scan_talk(pages, 5, ["q"]).count() == 1
    assert int(seen["talk-sections"]) <= 8 << 20 and spark.conf.get(BATCH) == before
