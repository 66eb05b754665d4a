"""URL filter: host and path rules, and gradient-boosted trees where no rule fits.

The trees see lexical features only: lengths, depth, digit ratio, entropy,
parameter counts and statistics of the host's suffix (its last label).  They
are trained on the URLs that a rule judges.  Suffix statistics are counted over
all URLs; the trees are fitted on at most ``SAMPLE`` different URLs a verdict
(in expectation, drawn by a hash of the URL, so copies of one URL count once).

Rules are a parameter, not a table: a list that is written into the plan as a
map from host to its rules.  A URL looks up the last few labels of its
host (as many as the longest rule host has), so its cost grows with its length.

Defined results: a null URL or one without ``://`` has an empty host and
path, fits no rule and is judged by its features; of equally long rules that fit
the one listed first wins; repeated rows are judged alike; without any URL that a
rule allows (blocks) what no rule fits is blocked (allowed), without either
it is allowed; an empty table gives no rows; columns other than page_id and url are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from renown.llm.common import ascii_lower
from renown.session import discard, materialize

#: Different URLs of each verdict that the trees are fitted on, at most (in expectation).
SAMPLE = 50_000
TREES, DEPTH = 20, 4


@dataclass(frozen=True)
class Rule:
    """Judges a host with all its subdomains, for paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
         Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))
FEATURES = ("url_length", "host_length", "path_length", "query_length", "depth", "labels", "digit_ratio", "hyphens",
            "parameters", "entropy", "suffix_urls", "suffix_blocked")


def with_parts(urls: DataFrame) -> DataFrame:
    """``urls`` (page_id, url) with u, host, path and query."""
    rest = F.expr("CASE WHEN locate('://', u) > 0 THEN substring(u, locate('://', u) + 3) ELSE '' END")
    return (urls.select("page_id", F.coalesce("url", F.lit("")).alias("u")).withColumn("rest", rest)
            .select("page_id", "u", ascii_lower(F.regexp_extract("rest", r"^[^/?#]*", 0)).alias("host"),
                    F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1).alias("path"),
                    F.regexp_extract("rest", r"^[^?#]*\?([^#]*)", 1).alias("query")))


def ruling(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits; null where none does."""
    kind = "array<struct<size:int,rule:string,verdict:string,path:string>>"
    if not rules:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    by_host: dict[str, list] = {}
    for place, r in enumerate(rules):
        by_host.setdefault(r.host, []).append(F.struct(
            F.lit(len(r.text) * len(rules) - place).alias("size"), F.lit(r.text).alias("rule"),
            F.lit(r.verdict).alias("verdict"), F.lit(r.path).alias("path")))
    known = F.create_map(*[x for h, found in by_host.items() for x in (F.lit(h), F.array(*found))])
    deepest = max(h.count(".") + 1 for h in by_host)
    ends = F.array_distinct(F.array(*[F.substring_index(host, ".", -n) for n in range(1, deepest + 1)]))
    fits = F.flatten(F.transform(ends, lambda e: F.coalesce(known[e], F.array().cast(kind))))
    best = F.array_max(F.filter(fits, lambda r: F.startswith(path, r["path"])))
    return F.when(best.isNotNull() & (host != ""), F.struct(best["rule"].alias("rule"), best["verdict"].alias("verdict")))


@F.pandas_udf(DoubleType())
def entropy(texts: pd.Series) -> pd.Series:
    """Bits a character, by the character counts of each text."""
    def of(t):
        return -sum(n / len(t) * math.log2(n / len(t)) for n in Counter(t).values()) if t else 0.0
    return texts.map(of)


def with_features(parts: DataFrame) -> DataFrame:
    """Lexical features of each URL that need no other URL, and its suffix."""
    size = F.greatest(F.length("u"), F.lit(1))
    pieces = {
        "url_length": F.length("u"), "host_length": F.length("host"), "path_length": F.length("path"),
        "query_length": F.length("query"), "depth": F.size(F.array_remove(F.split("path", "/", -1), "")),
        "labels": F.size(F.array_remove(F.split("host", r"\.", -1), "")),
        "digit_ratio": F.regexp_count("u", F.lit("[0-9]")) / size, "hyphens": F.regexp_count("host", F.lit("-")),
        "parameters": F.size(F.array_remove(F.split("query", "[&;]", -1), "")), "entropy": entropy("u"),
    }
    return parts.withColumns({k: v.cast("double") for k, v in pieces.items()}).withColumn(
        "suffix", F.substring_index("host", ".", -1))


def suffix_statistics(judged: DataFrame) -> DataFrame:
    """(suffix, suffix_urls, suffix_blocked): log of its URLs, and its share of blocks among ruled URLs, smoothed."""
    blocked = F.col("ruling.verdict") == "block"
    total = judged.groupBy("suffix").agg(F.count("*").alias("n"), F.count("ruling.verdict").alias("ruled"),
                                         F.count_if(blocked).alias("blocked"))
    return materialize(total.select("suffix", F.log1p("n").alias("suffix_urls"),
                                    ((F.col("blocked") + 1) / (F.col("ruled") + 2)).alias("suffix_blocked")), "url-suffixes")


def prepare(urls: DataFrame, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """Written rows (page_id, u, host, path, ruling, features) and the suffix statistics."""
    parts = with_features(with_parts(urls)).withColumn("ruling", ruling(F.col("host"), F.col("path"), rules))
    rows = materialize(parts, "url-features")
    return rows, suffix_statistics(rows)


def train(rows: DataFrame, suffixes: DataFrame, sample: int = SAMPLE, trees: int = TREES, depth: int = DEPTH):
    """A fitted classifier of ruled rows (label 1: block), or the one verdict that the rules gave ('allow' for none)."""
    ruled = rows.filter("ruling IS NOT NULL").select(
        "u", "suffix", (F.col("ruling.verdict") == "block").cast("double").alias("label"),
        *[f for f in FEATURES if not f.startswith("suffix")]).dropDuplicates(["u"])
    ruled = materialize(ruled.join(suffixes, "suffix"), "url-training")
    n = {r.label: r["count"] for r in ruled.groupBy("label").count().collect()}
    if len(n) < 2:
        discard(ruled)
        return "block" if 1.0 in n else "allow"
    draw = F.pmod(F.xxhash64("u"), F.lit(1 << 20)) / float(1 << 20)
    rate = F.when(F.col("label") == 1, sample / n[1.0]).otherwise(sample / n[0.0])
    fitted = GBTClassifier(featuresCol="x", maxIter=trees, maxDepth=depth, seed=1).fit(
        VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(ruled.filter(draw < rate)).select("x", "label"))
    discard(ruled)
    return fitted


def score(rows: DataFrame, suffixes: DataFrame, model) -> DataFrame:
    """``rows`` with ``score``, the probability of block."""
    if isinstance(model, str):
        return rows.withColumn("score", F.lit(float(model == "block")))
    known = rows.join(suffixes, "suffix")
    out = model.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(known))
    return out.withColumn("score", vector_to_array("probability")[1])


def judge(urls: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every URL."""
    rows, suffixes = prepare(urls, rules)
    scored = score(rows, suffixes, train(rows, suffixes))
    return scored.select("page_id", "host", "path", F.col("ruling.rule").alias("rule"), F.coalesce(
        "ruling.verdict", F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score")
