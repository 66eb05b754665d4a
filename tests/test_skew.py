"""One key on a third of the rows: the largest task of each join that may meet it."""

import pytest
from pyspark.sql import functions as F

from renown.operators.dedup import _undecided, deduplicate
from renown.session import materialize
from renown.sources import landed as L

LOW = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
       "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k", "spark.sql.files.maxPartitionBytes": "128k",
       "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k", "spark.sql.files.openCostInBytes": "16k",
       "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2", "spark.sql.shuffle.partitions": "16"}
N = 30_000


@pytest.fixture()
def low(spark):
    before = {k: spark.conf.get(k, None) for k in LOW}
    for k, v in LOW.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(i, name):
    return F.when(i % 3 == 0, F.lit(f"{name}-hot")).otherwise(F.concat(F.lit(f"{name}-"), F.md5(i.cast("string"))))


def rows(spark, n, *columns):
    """A written table of n numbered rows in 24 files, each row with text that does not compress."""
    i = F.col("id")
    return materialize(spark.range(0, n, 1, 24).select(i, F.sha2(i.cast("string"), 512).alias("pad"), *columns), "skew")


def split(df, is_hot):
    """Whether a join of the executed plan was split, the hot rows of the task with most of them, and of all tasks."""
    per_task = df.groupBy(F.spark_partition_id().alias("task")).agg(F.count_if(is_hot).alias("n"), F.max("pad"))  # pad crosses the shuffle
    n = [r.n for r in per_task.collect()]
    return "skewed" in per_task._jdf.queryExecution().executedPlan().toString(), max(n, default=0), sum(n)


def check(df, is_hot, total):
    cut, largest, found = split(df, is_hot)
    assert cut and found == total and largest < total / 3


def test_dedup_splits_a_hot_key(low):
    i = F.col("id")
    res = rows(low, N, i.alias("ord"), hot(i, "u").alias("uk"), F.concat(F.lit("t"), F.md5(i.cast("string"))).alias("tk"))
    # the hot key is not taken, so its rows come through both joins
    taken = materialize(low.range(1, 4000).select(F.concat(F.lit("u-"), F.md5((i * 3 + 1).cast("string"))).alias("key")), "skew")
    check(_undecided(res, taken), F.col("uk") == "u-hot", N // 3)


def test_redirects_split_a_hot_link(low):
    redirects = low.createDataFrame([("l-hot", "https://to.example/x")], "link string, final_url string")
    check(L.resolve_links(rows(low, N, hot(F.col("id"), "l").alias("link")), redirects), F.col("link") == "https://to.example/x", N // 3)


def test_fallbacks_split_a_hot_task(low):
    i = F.col("id")
    preferred = low.range(2000).select(i, F.lit("").alias("pad"), F.concat(F.lit("q-"), F.md5((i * 3 + 2).cast("string"))).alias("query"))
    check(L.with_fallback(preferred, rows(low, N, hot(i, "q").alias("query")), ["query"]), F.col("query") == "q-hot", N // 3)


def test_idle_fallbacks_split_a_hot_task(low):
    i = F.col("id")
    spare = i % 2 == 0
    body = F.concat(F.when(spare, "[").otherwise('{"statuses": ['), F.lit('{"url": "'), F.sha2(i.cast("string"), 512), F.lit('"}]'),
                    F.when(spare, "").otherwise("}"))
    responses = rows(low, N, F.lit("mastodon").alias("source"), hot(i, "q").alias("query"), F.lit("T").alias("target"),
                     F.lit("d").alias("retrieved_at"), body.alias("response"), F.lit("a").alias("_instance"),
                     F.when(spare | (i % 3 == 0), "tag").alias("_hashtag_fallback"))
    # the hot task landed fallbacks only, so all of them stay
    check(L._without_idle_fallbacks(L._with_items(responses)), F.col("query") == "q-hot", N // 3)


def test_dedup_of_hot_copies(low):
    i = F.col("id")
    copies = low.range(6000).select(
        i.alias("ord"), F.lit("news").alias("source"), F.lit("T").alias("target"),
        F.when(i % 3 == 0, "https://hot.example/1").otherwise(F.concat(F.lit("https://x.example/"), i.cast("string"))).alias("url"),
        F.concat(F.lit("title "), i.cast("string")).alias("title"), F.lit("x.example").alias("domain"))
    assert deduplicate(copies).count() == 4001
