"""Enrichment: language detection and sentiment as distributed Spark ML jobs.

The reference calls a per-row language detector and a transformer model.
Here both are re-aimed as models that Spark trains and applies:

* language: multinomial naive Bayes over character n-grams, counted by one
  aggregate on labelled text (``documents.text -> lang``); a prediction is used only
  if its probability is >= 0.80 and the text has >= 15 characters;
* sentiment: a ``Scorer`` gives (p_pos, p_neg) per row; the one here is a
  TF-IDF + multinomial logistic regression fitted on labelled rows.  Rows that
  are in the training data are scored by ``FoldedScorer``: each by a
  model that has not seen it.

Gates, overwrite rules and arithmetic (P(pos) - P(neg), clamp, round 6)
are native column expressions.  Only eligible rows are sent to a scorer.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from renown import params as P
from renown.functions.text import language_code, let, py_strip

_TOKEN_PATTERN = r"[\p{L}\p{N}_']+"


def analysis_text(title="title", text="text") -> Column:
    """Non-blank trimmed title and text joined by a space."""
    t1, t2 = py_strip(F.col(title)), py_strip(F.col(text))
    return F.concat_ws(" ", F.when(t1 != "", t1), F.when(t2 != "", t2))


def _features(input_col: str, num_features: int, idf: bool) -> list:
    stages = [RegexTokenizer(inputCol=input_col, outputCol="_tok", pattern=_TOKEN_PATTERN, gaps=False,
                             toLowercase=True),
              HashingTF(inputCol="_tok", outputCol="_tf" if idf else "_feat", numFeatures=num_features)]
    if idf:
        stages.append(IDF(inputCol="_tf", outputCol="_feat", minDocFreq=2))
    return stages


# ---------------------------------------------------------------------------
# language
# ---------------------------------------------------------------------------

#: Buckets that n-grams of three characters are dealt into: bounds the model.
GRAM_BUCKETS = 4096


def _lowered(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit("")))


def _bucketer() -> Callable[[str], np.ndarray]:
    """Function from a lower-cased text to its bucket numbers (a closure: shipped to the workers by value)."""
    def buckets(lowered):
        a = np.frombuffer(lowered.encode("utf-32-le"), np.uint32)
        return (a[:-2] * np.uint32(961) + a[1:-1] * np.uint32(31) + a[2:]) % np.uint32(GRAM_BUCKETS)
    return buckets


def gram_buckets(text: Column) -> Column:
    """Bucket numbers of the three-character runs of a text, lower-cased; linear in its length."""
    buckets = _bucketer()

    @F.pandas_udf("array<int>")
    def of(lowered: pd.Series) -> pd.Series:
        return lowered.map(lambda t: buckets(t).astype(np.int32))

    return of(_lowered(text))


@dataclass
class LanguageModel:
    """Multinomial naive Bayes over character n-grams.

    ``weights`` holds, for each label, the log probability of every bucket;
    ``priors`` the log share of its texts.  Both are small whatever the
    corpus (labels x buckets), so they go to the workers with the function and a
    text is scored where it is, without a join.
    """

    labels: list[str]
    priors: list[float]
    weights: list[list[float]]

    def probabilities(self, text: Column) -> Column:
        """Array of the labels' posterior probabilities, in the order of ``labels``."""
        buckets = _bucketer()
        table = np.vstack([np.array(self.weights).T, self.priors])  # the last row is the start of every sum

        @F.pandas_udf("array<double>")
        def scores(lowered: pd.Series) -> pd.Series:
            return lowered.map(lambda t: table[np.append(buckets(t), np.uint32(len(table) - 1))].sum(axis=0))

        def normalised(s):
            top = F.array_max(s)
            total = F.aggregate(s, F.lit(0.0), lambda acc, x: acc + F.exp(x - top))
            return F.transform(s, lambda x: F.exp(x - top) / total)

        return let(scores(_lowered(text)), normalised)

    def predict(self, df: DataFrame, text_col: str, out_col: str = "detected_language",
                min_len: int = P.NLP_MIN_LEN_DETECT,
                min_conf: float = P.NLP_LANG_DETECT_MIN_CONFIDENCE) -> DataFrame:
        """Append the detected ISO-1 code, NULL below the length/confidence gates (and for a model without labels)."""
        if not self.labels:
            return df.withColumn(out_col, F.lit(None).cast("string"))
        long_enough = F.length(F.col(text_col)) >= min_len
        own = F.when(long_enough, F.col(text_col))  # the others go as empty texts
        scored = df.withColumn("_prob", F.when(long_enough, self.probabilities(own)))
        names = F.array(*[F.lit(x) for x in self.labels])
        best = F.array_max("_prob")
        label = F.element_at(names, F.array_position("_prob", best).cast("int"))
        return scored.withColumn(out_col, F.when(best >= min_conf, language_code(label))).drop("_prob")


def fit_language_model(labelled: DataFrame, text_col: str = "text", label_col: str = "lang") -> LanguageModel:
    """Count the detector on (text, language) rows.

    One aggregation over all rows: n-grams per (label, bucket), counted by batch
    in the tasks, then summed.  What reaches the driver has at most labels x buckets rows.
    """
    buckets = _bucketer()

    def count(batches):
        for pdf in batches:
            for label, texts in pdf.groupby("label")["lowered"]:
                n = np.zeros(GRAM_BUCKETS, np.int64)
                for t in texts:
                    n += np.bincount(buckets(t), minlength=GRAM_BUCKETS)
                seen = np.nonzero(n)[0]
                yield pd.DataFrame({"label": label, "bucket": np.append(seen, -1), "n": np.append(n[seen], len(texts))})

    rows = labelled.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull()) \
                   .select(F.col(label_col).alias("label"), _lowered(F.col(text_col)).alias("lowered"))
    counts = rows.mapInPandas(count, "label string, bucket int, n long") \
                 .groupBy("label", "bucket").agg(F.sum("n").alias("n")).collect()
    labels = sorted({r.label for r in counts})
    found = {(r.label, r.bucket): r.n for r in counts}
    texts = {x: found[x, -1] for x in labels}                     # bucket -1 counts the texts
    weights = []
    for x in labels:
        own = [found.get((x, b), 0) + 1 for b in range(GRAM_BUCKETS)]
        total = sum(own)
        weights.append([math.log(n / total) for n in own])
    return LanguageModel(labels, [math.log(texts[x] / sum(texts.values())) for x in labels], weights)


# ---------------------------------------------------------------------------
# sentiment
# ---------------------------------------------------------------------------

class Scorer:
    """Contract: ``score(df, text_col)`` appends ``p_pos`` and ``p_neg`` (0..1)."""

    def score(self, df: DataFrame, text_col: str) -> DataFrame:  # pragma: no cover - interface
        raise NotImplementedError


@dataclass
class SparkMLScorer(Scorer):
    model: PipelineModel
    labels: list[str]

    def score(self, df: DataFrame, text_col: str) -> DataFrame:
        scored = self.model.transform(df.withColumn("_sent_text", F.col(text_col)))
        probs = vector_to_array(F.col("_prob"))

        def p(label):
            if label not in self.labels:
                return F.lit(0.0)
            return F.element_at(probs, self.labels.index(label) + 1)

        out = scored.withColumn("p_pos", p("positive")).withColumn("p_neg", p("negative"))
        return out.drop("_sent_text", "_tok", "_tf", "_feat", "_raw", "_prob", "_pred")


def fit_sentiment_scorer(labelled: DataFrame, text_col: str = "text", label_col: str = "label",
                         num_features: int = 1 << 16, max_iter: int = 20) -> SparkMLScorer:
    """TF-IDF + multinomial logistic regression on rows labelled positive/neutral/negative."""
    data = labelled.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull()) \
                   .select(F.col(text_col).alias("_sent_text"), F.col(label_col).alias("_label_str"))
    indexer = StringIndexer(inputCol="_label_str", outputCol="_label", stringOrderType="alphabetAsc")
    lr = LogisticRegression(featuresCol="_feat", labelCol="_label", family="multinomial", maxIter=max_iter,
                            regParam=0.01, rawPredictionCol="_raw", probabilityCol="_prob", predictionCol="_pred")
    pipe = Pipeline(stages=[indexer] + _features("_sent_text", num_features, idf=True) + [lr])
    model = pipe.fit(data)
    return SparkMLScorer(PipelineModel(model.stages[1:]), list(model.stages[0].labels))


@dataclass
class FoldedScorer(Scorer):
    """Scores each row by the scorer of its fold, which was fitted on the other folds.

    A scorer sees an empty text in place of the rows of other folds.
    """

    scorers: list[Scorer]
    fold: Callable[[], Column]

    def score(self, df: DataFrame, text_col: str) -> DataFrame:
        df = df.withColumn("_fold", self.fold())
        for i, scorer in enumerate(self.scorers):
            own = F.when(F.col("_fold") == i, F.col(text_col)).otherwise(F.lit(""))
            df = scorer.score(df.withColumn("_fold_text", own), "_fold_text") \
                .withColumnsRenamed({"p_pos": f"_pos{i}", "p_neg": f"_neg{i}"})
        for out, name in (("p_pos", "_pos"), ("p_neg", "_neg")):
            df = df.withColumn(out, F.coalesce(*[F.when(F.col("_fold") == i, F.col(f"{name}{i}"))
                                                 for i in range(len(self.scorers))], F.lit(0.0)))
        return df.drop("_fold", "_fold_text", *[f"{n}{i}" for n in ("_pos", "_neg") for i in range(len(self.scorers))])


def fit_folded_scorer(labelled: DataFrame, folds: int, fold_col: str = "fold", apply_fold: Callable[[], Column] | None = None,
                      **options) -> FoldedScorer:
    """A scorer for each fold, fitted on the rows of the others; ``apply_fold`` gives the fold of a row to score."""
    scorers = [fit_sentiment_scorer(labelled.where(F.col(fold_col) != i), **options) for i in range(folds)]
    return FoldedScorer(scorers, apply_fold or (lambda: F.col(fold_col)))


def _words(text: Column) -> Column:
    """Runs of a-z in the lower-cased text."""
    return F.split(F.lower(text), "[^a-z]+")


def _hits(words: Column, known: Iterable[str]) -> Column:
    listed = sorted(known)
    return F.size(F.filter(words, lambda w: w.isin(listed)))


@dataclass
class LexiconScorer(Scorer):
    """Shares of positive and negative words among the words of either list; 0 and 0 without one."""

    positive: frozenset[str]
    negative: frozenset[str]

    def score(self, df: DataFrame, text_col: str) -> DataFrame:
        df = df.withColumn("_hits", let(_words(F.col(text_col)), lambda ws: F.struct(
            _hits(ws, self.positive).alias("pos"), _hits(ws, self.negative).alias("neg"))))
        both = F.greatest(F.col("_hits.pos") + F.col("_hits.neg"), F.lit(1))
        return df.withColumns({"p_pos": F.col("_hits.pos") / both, "p_neg": F.col("_hits.neg") / both}).drop("_hits")


@dataclass
class WordListLanguage:
    """Language by function words: the label with the most hits (ties: the first label), NULL without any."""

    words: dict[str, frozenset[str]]

    def predict(self, df: DataFrame, text_col: str, out_col: str = "detected_language") -> DataFrame:
        def best(ws):
            return F.array_max(F.array(*[
                F.struct(_hits(ws, known).alias("n"), F.lit(-i).alias("i"), F.lit(label).alias("label"))
                for i, (label, known) in enumerate(self.words.items())]))

        found = let(let(_words(F.col(text_col)), best), lambda b: F.when(b["n"] > 0, b["label"]))
        return df.withColumn(out_col, let(found, language_code))


def sentiment_labels(labels: DataFrame, docs: DataFrame) -> DataFrame:
    """Training rows from the labelled documents: quality - toxic -> class."""
    d = docs.select("doc_id", "text").join(labels.select("doc_id", "quality", "toxic"), "doc_id")
    v = F.col("quality") - F.col("toxic")
    return d.select("doc_id", "text", F.when(v > 0, "positive").when(v < 0, "negative").otherwise("neutral").alias("label"))


# ---------------------------------------------------------------------------
# record enrichment
# ---------------------------------------------------------------------------

def needs_detection(atext: Column, declared: Column) -> Column:
    """Rows without a recognised language whose text is long enough for the detector."""
    return (F.length(atext) >= P.NLP_MIN_LEN_DETECT) & declared.isNull()


def sentiment_eligible(atext: Column, language: Column) -> Column:
    """Rows whose text is long enough for the scorer, in a supported or unknown language."""
    return (F.length(atext) >= P.NLP_MIN_LEN_SENTIMENT) & \
           (language.isNull() | language.isin(sorted(P.SENTIMENT_SUPPORTED_LANGS)))


def enrich(records: DataFrame, language_model: LanguageModel | None, scorer: Scorer | None,
           observe: bool = False) -> DataFrame | tuple[DataFrame, Observation]:
    """Resolve language and score sentiment; row count and order unchanged.

    language = normalised declared language if recognised, else detected.
    sentiment is recomputed for every row: eligible rows (analysis text of
    >= 15 chars, language NULL or supported) are scored, all others get
    NULL (a preset sentiment is overwritten, as in the reference).

    One pass over the input: rows that need no detection / no scoring are
    given an empty text (no tokens, no model work) instead of being split
    off and unioned back, which would evaluate the input plan twice.
    """
    cols = records.columns
    df = records.withColumn("_atext", analysis_text())
    declared = language_code(F.col("language"))
    df = df.withColumn("_decl", declared)
    if language_model is not None:
        df = df.withColumn("_dtext", F.when(needs_detection(F.col("_atext"), F.col("_decl")), F.col("_atext"))
                           .otherwise(F.lit("")))
        df = language_model.predict(df, "_dtext", out_col="_det").drop("_dtext")
    else:
        df = df.withColumn("_det", F.lit(None).cast("string"))
    df = df.withColumn("language", F.coalesce(F.col("_decl"), F.col("_det")))

    if scorer is not None:
        df = df.withColumn("_elig", sentiment_eligible(F.col("_atext"), F.col("language")))
        df = df.withColumn("_stext", F.when(F.col("_elig"), F.col("_atext")).otherwise(F.lit("")))
        df = scorer.score(df, "_stext")
        s = F.round(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("p_pos") - F.col("p_neg"))), 6)
        df = df.withColumn("sentiment", F.when(F.col("_elig"), s))
    else:
        df = df.withColumn("sentiment", F.lit(None).cast("double"))
    out = df.select(*[c for c in cols if c != "sentiment"], F.col("sentiment").cast("double").alias("sentiment"))
    if not observe:
        return out
    obs = Observation("enrichment")
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"), F.count("language").alias("with_language"),
                      F.count("sentiment").alias("with_sentiment"))
    return out, obs
