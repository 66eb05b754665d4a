"""Enrichment gates: language resolution, eligibility, overwrite, arithmetic."""

import math

import pytest
from pyspark.sql import functions as F

from renown.operators.enrich import (GRAM_BUCKETS, FoldedScorer, LexiconScorer, Scorer, WordListLanguage, analysis_text, enrich, fit_folded_scorer, fit_language_model,
                                     gram_buckets)
from renown.plans.q_enrich import detect_language


class ConstScorer(Scorer):
    """p_pos = 0.9, p_neg = 0.15 for every text it is asked about."""

    def __init__(self):
        self.seen = None

    def score(self, df, text_col):
        return df.withColumn("p_pos", F.lit(0.9)).withColumn("p_neg", F.lit(0.15))


REC = "ord long, title string, text string, language string, sentiment double"


def test_gates_and_overwrite(spark):
    rows = [
        (1, "Title", "long enough english text", "EN-us", 0.5),   # scored, declared kept
        (2, "", "short", None, 0.9),                               # < 15 chars -> NULL (overwritten)
        (3, "Titolo", "testo abbastanza lungo qui", "ja", None),   # unsupported -> NULL
        (4, " ", "  another long enough text  ", None, None),     # NULL language still scored
    ]
    df = spark.createDataFrame(rows, REC)
    out = {r.ord: (r.language, r.sentiment) for r in enrich(df, None, ConstScorer()).collect()}
    assert out == {1: ("en", 0.75), 2: (None, None), 3: ("ja", None), 4: (None, 0.75)}
    assert spark.createDataFrame(rows, REC).select(analysis_text().alias("a")).collect()[3].a == \
        "another long enough text"


def test_detection_threshold(spark):
    train = spark.createDataFrame(
        [("the cat and the dog are in the house with the family", "en")] * 20
        + [("der hund und die katze sind im haus mit der familie", "de")] * 20, "text string, lang string")
    lm = fit_language_model(train)
    rows = [(1, "", "the dog and the cat in the house", None, None),
            (2, "", "der hund und die katze im haus", None, None),
            (3, "", "short", None, None),
            (4, "", "the cat", "fr", None)]
    out = {r.ord: r.language for r in enrich(spark.createDataFrame(rows, REC), lm, None).collect()}
    assert out == {1: "en", 2: "de", 3: None, 4: "fr"}


def test_gram_buckets(spark):
    rows = spark.createDataFrame([("aBc d",), ("é你",), ("",), (None,)], "t string").select(gram_buckets(F.col("t")).alias("b")).collect()
    code = [ord(c) for c in "abc d"]
    assert rows[0].b == [(code[i] * 961 + code[i + 1] * 31 + code[i + 2]) % 4096 for i in range(3)]
    assert rows[1].b == rows[2].b == rows[3].b == []
    none = fit_language_model(spark.createDataFrame([], "text string, lang string"))
    assert [r.detected_language for r in none.predict(spark.createDataFrame([("x" * 50,)], "text string"), "text").collect()] == [None]


class FoldScorer(Scorer):
    def __init__(self, p):
        self.p = p

    def score(self, df, text_col):
        return df.withColumn("p_pos", F.when(F.col(text_col) != "", F.lit(self.p)).otherwise(0.0)).withColumn("p_neg", F.lit(0.0))


def test_rows_are_scored_by_the_model_of_their_fold(spark):
    rows = spark.createDataFrame([(i, "", f"a text that is long enough {i}", "en", None) for i in range(6)], REC)
    out = enrich(rows, None, FoldedScorer([FoldScorer(0.1), FoldScorer(0.7)], lambda: (F.col("ord") % 2).cast("int"))).collect()
    assert {r.ord: r.sentiment for r in out} == {i: 0.7 if i % 2 else 0.1 for i in range(6)}


def test_a_fold_is_not_fitted_on_its_own_rows(spark):
    """Word w0 is positive in fold 0 and negative in fold 1: each fold is scored by what the other says."""
    rows = [(f"w0 filler{i % 5} words", "positive" if f == 0 else "negative", f) for i in range(40) for f in (0, 1)]
    rows += [(f"neutral filler{i % 5} words", "neutral", i % 2) for i in range(40)]
    data = spark.createDataFrame(rows, "text string, label string, fold int")
    scored = fit_folded_scorer(data, 2).score(data.where("label <> 'neutral'"), "text")
    assert all((r.p_neg > r.p_pos) == (r.fold == 0) for r in scored.collect())


def test_word_lists_plug_into_enrichment(spark):
    rows = [(1, "the state of the art and more", None), (2, "der Hund und die Katze gut", None), (3, "zzzz qqqq zzzz qqqq xx", None),
            (4, "the good one of the lot, not bad", "de"), (5, "", None), (6, None, None)]
    records = spark.createDataFrame([(i, "", t, c, None) for i, t, c in rows],
                                    "ord long, title string, text string, language string, sentiment double")
    words = WordListLanguage({"en": frozenset({"the", "of"}), "de": frozenset({"der", "die"})})
    scorer = LexiconScorer(frozenset({"good"}), frozenset({"not", "bad"}))
    out, seen = enrich(records, words, scorer, observe=True)
    got = {r.ord: (r.language, r.sentiment) for r in out.select("ord", "language", "sentiment").collect()}
    assert got == {1: ("en", 0.0), 2: ("de", 0.0), 3: (None, 0.0), 4: ("de", round(1 / 3 - 2 / 3, 6)), 5: (None, None), 6: (None, None)}
    assert seen.get == {"rows": 6, "with_language": 3, "with_sentiment": 4}
    tie = spark.createDataFrame([("the die",), (None,)], "t string")
    assert [r.l for r in words.predict(tie, "t", "l").collect()] == ["en", None]


def test_run_timestamp(spark):
    from renown.functions.dates import run_timestamp
    row = spark.sql("SELECT timestamp '2026-04-09 12:00:00.9 UTC' AS t, CAST(NULL AS timestamp) AS n") \
        .select(run_timestamp("t"), run_timestamp("n"), run_timestamp()).first()
    assert row[:2] == ("20260409T120000Z", None) and len(row[2]) == 16


def test_language_counts_and_scores_come_from_plain_loops(spark):
    texts = [("Ünï ΣΑΣ 你好 abc", "xx"), ("ab", "xx"), ("", "yy"), ("der die das " * 30, "yy"), (None, "yy"), ("abc", None)]
    lm = fit_language_model(spark.createDataFrame(texts, "text string, lang string").repartition(3))
    assert lm.labels == ["xx", "yy"] and lm.priors == [math.log(0.5)] * 2
    grams = {}
    for text, lang in texts[:4]:
        a = [ord(c) for c in text.lower()]
        grams.setdefault(lang, []).extend((a[i] * 961 + a[i + 1] * 31 + a[i + 2]) % GRAM_BUCKETS for i in range(len(a) - 2))
    for own, x in zip(lm.weights, lm.labels):
        assert own == [math.log((grams[x].count(b) + 1) / (len(grams[x]) + GRAM_BUCKETS)) for b in range(GRAM_BUCKETS)]
    probe = "der abc das 你好 abc"
    a = [ord(c) for c in probe]
    sums = [p + sum(w[(a[i] * 961 + a[i + 1] * 31 + a[i + 2]) % GRAM_BUCKETS] for i in range(len(a) - 2))
            for p, w in zip(lm.priors, lm.weights)]
    got = spark.createDataFrame([(probe,)], "t string").select(lm.probabilities(F.col("t")).alias("p")).collect()[0].p
    total = sum(math.exp(s - max(sums)) for s in sums)
    assert got == pytest.approx([math.exp(s - max(sums)) / total for s in sums], rel=1e-9)


def test_language_work_is_not_left_to_one_task(spark, tmp_path):
    spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("some words "), F.col("id")).alias("text"),
                            F.lit("en").alias("lang")).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    own = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert detect_language(spark, str(tmp_path)).rdd.getNumPartitions() == int(own)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
