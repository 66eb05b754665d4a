"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over the presence of words and word beginnings is
fitted with numpy from confirmed toxic documents and unlabelled ones.  With p the share of toxic
documents (from the training labels), the risk is

    p * R_pos(+1) + max(0, R_unl(-1) - p * R_pos(-1))

where the second term, an estimate of the risk on clean text, is held at
zero from below; while it is negative the step goes the other way.  Which
features are used depends on their share among the confirmed toxic
documents and among all documents (labels not looked at), counted by a
Spark aggregation.  Only the gradient works on a bounded sample
(``positives`` and ``unlabelled`` rows, smallest id hashes first); every
whole document is scored.

Defined results: null text scores as the empty text; a null doc_id counts
as the empty id text for the fold; repeated label rows count once, as
toxic if any says so; without any toxic training label every score is 0.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renown.llm.common import id_text

BUCKETS = 1 << 20
_WORD = re.compile(r"[^\W\d_]+")


def features_of(text: str | None) -> set[str]:
    """Distinct words of a text in lower case, and their first four and five letters (marked ^)."""
    words = set(_WORD.findall((text or "").lower()))
    return words | {"^" + w[:4] for w in words} | {"^" + w[:5] for w in words}


def bucket(feature: str) -> int:
    return zlib.crc32(feature.encode()) % BUCKETS


def held_out(c: Column, folds: int = 5) -> Column:
    return F.crc32(id_text(c)) % folds == 0


def _first_ids(ids: DataFrame, n: int) -> DataFrame:
    """The ``n`` ids with the smallest hashes."""
    return ids.dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)


def _sample(docs: DataFrame, ids: DataFrame, n: int) -> list[np.ndarray]:
    """Hashed words of the ``n`` documents with the smallest id hashes among ``ids``."""
    def features(batches):
        for pdf in batches:
            yield pd.DataFrame({"f": [np.unique(np.array([*map(bucket, features_of(t))], "<i4")).tobytes()
                                      for t in pdf["text"]]})

    rows = docs.join(F.broadcast(_first_ids(ids, n)), "doc_id").select("text").mapInPandas(features, "f binary").limit(n).collect()
    return [np.frombuffer(r.f, "<i4") for r in rows]


class _Buckets(dict):
    """Buckets of a word's features by word, for the words seen so far in a task; bounded."""

    def __init__(self, most: int = 1 << 17):
        super().__init__()
        self.most = most

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = tuple(map(bucket, features_of(word)))
        return value


def document_counts(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """Feature buckets (b) with n, in how many of all documents each occurs, and p, in how many with an id of ``marked``.

    A task sends two numbers a bucket.  ``marked`` is bounded and sent to all tasks.
    """
    def count(batches):
        found, known = np.zeros((2, BUCKETS), "<i8"), _Buckets()
        for pdf in batches:
            for text, mark in zip(pdf["text"], pdf["marked"]):
                mine = set()
                for word in set(_WORD.findall((text or "").lower())):
                    mine.update(known[word])
                at = np.fromiter(mine, "<i8", len(mine))
                found[0, at] += 1
                if mark:
                    found[1, at] += 1
        used = np.flatnonzero(found[0])
        yield pd.DataFrame({"b": used, "n": found[0, used], "p": found[1, used]})

    ids = marked.select(F.col("doc_id").alias("of"))
    rows = docs.join(F.broadcast(ids), F.col("doc_id") == F.col("of"), "left")
    return (rows.select("text", F.col("of").isNotNull().alias("marked")).mapInPandas(count, "b long, n long, p long")
            .groupBy("b").agg(F.sum("n").alias("n"), F.sum("p").alias("p")))


def telling_features(docs: DataFrame, marked: DataFrame, features: int = 2048) -> list[int]:
    """The buckets whose share among the documents of ``marked`` differs most from that among all documents."""
    rows, some = docs.count(), docs.join(F.broadcast(marked), "doc_id").count()
    if not some:
        return []
    share = F.col("n") / rows
    gain = F.abs(F.col("p") / some - share) / F.sqrt(share + 1 / some)  # no share of p is finer than 1 / some
    return [r.b for r in document_counts(docs, marked).orderBy(gain.desc(), "b").limit(features).collect()]


class Model:
    """Weights by feature bucket and a bias."""

    def __init__(self, weight: dict[int, float], bias: float):
        self.weight, self.bias = weight, bias

    def score(self, text: str | None, known: "_Known") -> float:
        z = self.bias + math.fsum(map(known.__getitem__, features_of(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


class _Known(dict):
    """Weights of the features seen so far in a task; bounded."""

    def __init__(self, model: Model, most: int = 1 << 18):
        super().__init__()
        self.weight, self.most = model.weight, most

    def __missing__(self, feature: str) -> float:
        if len(self) >= self.most:
            self.clear()
        value = self[feature] = self.weight.get(bucket(feature), 0.0)
        return value


def fit_pu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, used: list[int],
           steps: int = 250, rate: float = 0.1, decay: float = 2e-4) -> Model:
    """Non-negative PU risk, logistic loss, Adam, over the buckets ``used``."""
    if not positive or not unlabelled or prior <= 0:
        return Model({}, -30.0)

    used = np.sort(np.array(used, np.int64))
    place = np.full(BUCKETS, -1)
    place[used] = np.arange(len(used))

    def matrix(rows):
        at = [place[r][place[r] >= 0] for r in rows]
        return np.repeat(np.arange(len(rows)), [len(a) for a in at]), np.concatenate(at)

    (pr, pc), (ur, uc) = matrix(positive), matrix(unlabelled)
    n_p, n_u, w, b = len(positive), len(unlabelled), np.zeros(len(used)), -1.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0

    def sigmoid(z):
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    for t in range(1, steps + 1):
        zp = b + np.bincount(pr, w[pc], n_p)
        zu = b + np.bincount(ur, w[uc], n_u)
        sp, su = sigmoid(zp), sigmoid(zu)
        clean = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        if clean >= 0:  # gradient of the whole risk by each row's logit
            gp, gu = prior * (sp - 1) / n_p - prior * sp / n_p, su / n_u
        else:
            gp, gu = prior * sp / n_p, -su / n_u
        g = np.bincount(pc, gp[pr], len(w)) + np.bincount(uc, gu[ur], len(w)) + decay * w
        gb = gp.sum() + gu.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        a, c = 1 - 0.9 ** t, 1 - 0.999 ** t
        w = w - rate * (m / a) / (np.sqrt(v / c) + 1e-8)
        b = b - rate * (mb / a) / (np.sqrt(vb / c) + 1e-8)
    return Model(dict(zip(used.tolist(), w.tolist())), float(b))


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, positives: int = 4000,
          unlabelled: int = 12000) -> Model:
    """Fit from training-fold labels; the class prior is the toxic share among them.

    Features are chosen by counts over the whole of ``docs``; the confirmed and unlabelled rows are bounded.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    marks = (labels.filter(~held_out(F.col("doc_id"), folds) & F.col("toxic").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic")))
    stats = marks.agg(F.avg("toxic").alias("prior")).first()
    ids = docs.select("doc_id").filter(~held_out(F.col("doc_id"), folds))
    toxic = marks.filter("toxic = 1").select("doc_id")
    return fit_pu(_sample(docs, toxic, positives), _sample(docs, ids, unlabelled), float(stats.prior or 0.0),
                  telling_features(docs, _first_ids(toxic, positives)))


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows that score 0.5 or more."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weight, model.bias))

    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = Model(*shared.value)
        known = _Known(model)
        for part in texts:
            yield pd.Series([model.score(t, known) for t in part], dtype="float64")

    return docs.filter(F.pandas_udf(score, "double")("text") < 0.5)


def score_documents(docs: DataFrame, model: Model, folds: int = 5) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weight, model.bias))  # at most fit_pu's features

    def score(batches):
        model = Model(*shared.value)
        known = _Known(model)
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "held_out": pdf["held_out"],
                                "score": [model.score(t, known) for t in pdf["text"]]})

    rows = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id"), folds).alias("held_out"), "text")
    return (rows.mapInPandas(score, "doc_id long, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
