"""Reputation summary cases (weighted sentiment, trust, recency, volume, trend)."""

import datetime as dt
import math

import pytest

from renown import params as P
from renown.operators.summary import reputation_summary

SCHEMA = "target string, source string, ord long, query string, topic string, sentiment double, date date"
SP = P.SummaryParams(as_of="2026-04-08")


def _rows(items):
    out = []
    for i, it in enumerate(items):
        d = it.get("date")
        out.append((it.get("target", "T"), it.get("source", "news"), i, it.get("query", "q"),
                    it.get("topic", "t"), it.get("sentiment"), dt.date.fromisoformat(d) if d else None))
    return out


def summ(spark, items):
    df = spark.createDataFrame(_rows(items), SCHEMA)
    return reputation_summary(df, SP).collect()[0]


def test_weighted_average_and_std(spark):
    r = summ(spark, [{"source": "guardian", "sentiment": 0.8}, {"source": "reddit", "sentiment": -0.4}])
    avg = (0.8 * 1.0 - 0.4 * 0.55) / 1.55
    assert r.sentiment_avg == pytest.approx(round(avg, 6), abs=1e-6)
    var = (1.0 * (0.8 - avg) ** 2 + 0.55 * (-0.4 - avg) ** 2) / 1.55
    assert r.sentiment_std == pytest.approx(round(math.sqrt(var), 6), abs=1e-6)
    assert r.records_with_sentiment == 2


def test_single_record_has_no_std(spark):
    r = summ(spark, [{"sentiment": 0.5}])
    assert r.sentiment_std is None
    assert r.record_count == 1


def test_no_sentiment_gives_neutral_component(spark):
    r = summ(spark, [{"source": "guardian"}, {"source": "nyt"}])
    assert r.sentiment_avg is None and r.records_with_sentiment == 0
    trust = round((1.0 + 0.95) / 2, 6)
    vol = round(math.log(3) / (math.log(3) + math.log(101)), 6)
    exp = round(0.4 * 0.5 + 0.3 * trust + 0.2 * 0.0 + 0.1 * vol, 4)
    assert r.reputation_score == pytest.approx(exp, abs=1e-4)


def test_trust_excludes_low_weight_sources_unless_all_low(spark):
    r = summ(spark, [{"source": "guardian"}, {"source": "reddit"}, {"source": "reddit"}])
    assert r.source_trust_avg == pytest.approx(1.0)
    r2 = summ(spark, [{"source": "reddit"}, {"source": "unknown_src"}])
    assert r2.source_trust_avg == pytest.approx(round((0.55 + 0.5) / 2, 6))


def test_volume_half_saturation(spark):
    r = summ(spark, [{} for _ in range(100)])
    assert r.volume_score == pytest.approx(0.5)


def test_recency_future_and_missing_dates(spark):
    r = summ(spark, [{"date": "2026-04-08"}, {"date": "2026-03-09"}, {"date": "2027-01-01"}, {}])
    exp = round((1.0 + 0.5 + 1.0) / 3, 6)
    assert r.recency_score == pytest.approx(exp)
    r2 = summ(spark, [{}])
    assert r2.recency_score == 0.0


@pytest.mark.parametrize("vals,expected", [
    ([-0.5, 0.0, 0.5], "up"),
    ([0.5, 0.0, -0.5], "down"),
    ([0.1, 0.1, 0.1], "stable"),
])
def test_trend(spark, vals, expected):
    items = [{"sentiment": v, "date": f"2026-04-0{i + 1}"} for i, v in enumerate(vals)]
    assert summ(spark, items).trend == expected


def test_trend_unknown_and_same_day(spark):
    assert summ(spark, [{"sentiment": 0.1, "date": "2026-04-01"}] * 2).trend == "unknown"
    same = [{"sentiment": v, "date": "2026-04-01"} for v in (-1.0, 0.0, 1.0)]
    assert summ(spark, same).trend == "stable"


def test_irregular_dates_use_day_distance(spark):
    items = [{"sentiment": -0.9, "date": "2026-01-01"}, {"sentiment": -0.8, "date": "2026-01-02"},
             {"sentiment": 0.9, "date": "2026-04-01"}]
    assert summ(spark, items).trend == "up"


def test_distribution_and_queries(spark):
    items = [{"source": "nyt", "query": "b"}, {"source": "bbc", "query": "a"},
             {"source": "bbc", "query": ""}, {"source": "nyt", "query": "a"}, {"source": "news"}]
    r = summ(spark, items)
    assert [(e.source, e["count"]) for e in r.source_distribution] == [("nyt", 2), ("bbc", 2), ("news", 1)]
    assert r.queries == ["a", "b", "q"]


def test_one_row_per_target(spark):
    items = [{"target": "A"}, {"target": "B"}, {"target": "A"}]
    df = spark.createDataFrame(_rows(items), SCHEMA)
    got = {r.entity: r.record_count for r in reputation_summary(df, SP).collect()}
    assert got == {"A": 2, "B": 1}


def test_hot_target_matches_single_pass(spark):
    """A target with a third of the rows gives the same numbers as a direct computation."""
    items = []
    for i in range(600):
        tgt = "HOT" if i % 3 == 0 else f"T{i % 7}"
        src = ["guardian", "reddit", "news", "forum"][i % 4]
        items.append({"target": tgt, "source": src, "sentiment": ((i % 11) - 5) / 5.0,
                      "date": f"2026-03-{(i % 28) + 1:02d}"})
    df = spark.createDataFrame(_rows(items), SCHEMA)
    r = [x for x in reputation_summary(df, SP).collect() if x.entity == "HOT"][0]
    hot = [it for it in items if it["target"] == "HOT"]
    w = {"guardian": 1.0, "reddit": 0.55, "news": 0.85, "forum": 0.5}
    sw = sum(w[it["source"]] for it in hot)
    avg = sum(w[it["source"]] * it["sentiment"] for it in hot) / sw
    std = math.sqrt(sum(w[it["source"]] * (it["sentiment"] - avg) ** 2 for it in hot) / sw)
    assert r.record_count == 200
    assert r.sentiment_avg == pytest.approx(round(avg, 6), abs=1e-6)
    assert r.sentiment_std == pytest.approx(round(std, 6), abs=1e-6)


def test_published_volume_value(spark):
    """236 records -> volume 0.542295, the value in the reference's sample summary."""
    r = summ(spark, [{} for _ in range(236)])
    assert r.volume_score == pytest.approx(0.542295, abs=1e-6)
