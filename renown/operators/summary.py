"""Per-entity reputation summary (one row per target).

Plan shape, chosen for scale:

1. one scan of the records, projected to the few columns used;
2. queries and topics are made distinct as (target, value) rows of their own;
   ``groupBy(target, source)`` with map-side partial aggregation -- the
   hot-key case (one target holding a third of the rows) is absorbed by
   the partial aggregates, only one row per (task, target, source) is
   shuffled;
3. the (target, source) rows -- bounded by #targets x #sources -- are
   hash-partitioned once on ``target``; a window over that partition
   gives the target means and the final ``groupBy(target)`` reuses the
   same partitioning (no further exchange).

Weighted standard deviation and the trend slope are merged from
per-source central moments (``var_pop``/``covar_pop`` are computed with
Spark's stable merge), so there is no second pass over the records and
no broadcast whose size grows with the number of targets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from renown import params as P


def source_weight(source_col: Column, weights: dict[str, float] | None = None,
                  default: float = P.SOURCE_WEIGHT_DEFAULT) -> Column:
    """Authority weight of a source; a literal map lookup (no join needed)."""
    weights = weights if weights is not None else P.SOURCE_WEIGHTS
    items = []
    for k, v in weights.items():
        items += [F.lit(k), F.lit(float(v))]
    return F.coalesce(F.try_element_at(F.create_map(*items), source_col), F.lit(float(default)))


def per_source_stats(records: DataFrame, sp: P.SummaryParams | None = None) -> DataFrame:
    """The (target, source) partial aggregates the summary is merged from."""
    return _per_source(records, sp or P.SummaryParams())


def keyed_stats(records: DataFrame, sp: P.SummaryParams | None = None) -> DataFrame:
    """The same aggregates and the distinct names as one streaming aggregation.

    Its state has a row per (target, source) (``kind`` s) and one per distinct
    query and topic of a target (q, t); no row of it grows.
    """
    return _per_source(records, sp or P.SummaryParams(), keyed=True)


def _per_source(records: DataFrame, sp: P.SummaryParams, keyed: bool = False) -> DataFrame:
    as_of = F.lit(sp.as_of).cast("date")
    s = F.col("sentiment").cast("double")
    d = F.col("date")
    both = d.isNotNull() & s.isNotNull()
    x = F.when(both, F.datediff(d, F.lit("1970-01-01").cast("date")).cast("double"))
    y = F.when(both, s)
    age = F.greatest(F.lit(0), F.datediff(as_of, d))
    decay = F.when(d.isNotNull(), F.pow(F.lit(2.0), -age.cast("double") / F.lit(float(sp.half_life_days))))
    base = records.select(
        "target", "source", "ord", "query", "topic",
        s.alias("s"), d.alias("d"), x.alias("x"), y.alias("y"), decay.alias("decay"),
    )
    if keyed:
        # one state row per value instead of a set that grows inside a row
        own = [F.when(F.col("k.kind") == "s", F.col(c)).alias(c) for c in ("source", "ord", "s", "d", "x", "y", "decay")]
        base = base.withColumn("k", F.explode(F.array(
            F.struct(F.lit("s").alias("kind"), F.lit("").alias("value")), *_named()))) \
            .where((F.col("k.kind") == "s") | (F.col("k.value") != "")).select("target", "k.kind", "k.value", *own)
    return base.groupBy("target", "source", *(["kind", "value"] if keyed else [])).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("ord").alias("first_ord"),
        F.count("s").alias("ns"),
        F.avg("s").alias("ms"),
        (F.var_pop("s") * F.count("s")).alias("m2s"),
        F.count("d").alias("nd"),
        F.sum("decay").alias("decay_sum"),
        F.min("d").alias("dmin"),
        F.max("d").alias("dmax"),
        F.count("x").alias("nxy"),
        F.avg("x").alias("mx"),
        F.avg("y").alias("my"),
        (F.covar_pop("y", "x") * F.count("x")).alias("cxy"),
        (F.var_pop("x") * F.count("x")).alias("m2x"),
    )


def _named() -> list[Column]:
    return [F.struct(F.lit("q").alias("kind"), F.col("query").alias("value")),
            F.struct(F.lit("t").alias("kind"), F.col("topic").alias("value"))]


def distinct_names(records: DataFrame) -> DataFrame:
    """(target, kind, value): the queries (q) and topics (t) of each target, each once, before anything is folded."""
    return records.select("target", F.explode(F.array(*_named())).alias("k")).where(F.col("k.value") != "") \
        .select("target", "k.kind", "k.value").distinct()


def reputation_summary(records: DataFrame, sp: P.SummaryParams | None = None,
                       weights: dict[str, float] | None = None) -> DataFrame:
    """Aggregate records (target, source, ord, query, topic, sentiment, date).

    Returns one row per target with the reference's summary fields;
    ``source_distribution`` is an array of (source, count) sorted by count
    desc, ties by first appearance; ``date_range`` a struct (from, to).
    """
    sp = sp or P.SummaryParams()
    return summary_from_stats(_per_source(records, sp), distinct_names(records), sp, weights)


def summary_from_stats(stats: DataFrame, names: DataFrame, sp: P.SummaryParams | None = None,
                       weights: dict[str, float] | None = None) -> DataFrame:
    """Finish the summary from ``per_source_stats`` and ``distinct_names`` rows (batch or streaming state)."""
    sp = sp or P.SummaryParams()
    g = stats.withColumn("w", source_weight(F.col("source"), weights))

    wt = Window.partitionBy("target")
    ns0 = F.coalesce(F.col("ns"), F.lit(0))
    g = g.withColumn("sw", F.col("w") * ns0)
    # one Window operator: all target-level sums share the same spec
    g = g.select(
        "*",
        F.sum(F.col("sw") * F.coalesce(F.col("ms"), F.lit(0.0))).over(wt).alias("_swm"),
        F.sum("sw").over(wt).alias("_sw"),
        F.sum(F.col("nxy") * F.coalesce(F.col("mx"), F.lit(0.0))).over(wt).alias("_sx"),
        F.sum(F.col("nxy") * F.coalesce(F.col("my"), F.lit(0.0))).over(wt).alias("_sy"),
        F.sum("nxy").over(wt).alias("_sn"),
    )
    g = g.withColumns({
        "mu": F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide(F.col("_swm"), F.col("_sw")))),
        "MX": F.try_divide(F.col("_sx"), F.col("_sn")),
        "MY": F.try_divide(F.col("_sy"), F.col("_sn")),
    })

    trusted = F.col("w") >= F.lit(sp.min_source_trust)
    agg = g.groupBy("target").agg(
        F.sum("n").alias("record_count"),
        F.sum("ns").alias("n_sent"),
        F.sum("sw").alias("W"),
        F.first("mu").alias("mu"),
        F.sum(F.col("w") * (F.coalesce(F.col("m2s"), F.lit(0.0))
                            + ns0 * F.pow(F.coalesce(F.col("ms"), F.lit(0.0)) - F.col("mu"), 2))).alias("M2"),
        F.sum(F.when(trusted, F.col("n") * F.col("w"))).alias("trust_num"),
        F.sum(F.when(trusted, F.col("n"))).alias("trust_den"),
        F.sum(F.col("n") * F.col("w")).alias("all_num"),
        F.sum("decay_sum").alias("decay_sum"),
        F.sum("nd").alias("nd"),
        F.min("dmin").alias("date_from"),
        F.max("dmax").alias("date_to"),
        F.sum("nxy").alias("nxy"),
        F.sum(F.coalesce(F.col("cxy"), F.lit(0.0))
              + F.col("nxy") * (F.coalesce(F.col("mx"), F.lit(0.0)) - F.col("MX"))
              * (F.coalesce(F.col("my"), F.lit(0.0)) - F.col("MY"))).alias("CXY"),
        F.sum(F.coalesce(F.col("m2x"), F.lit(0.0))
              + F.col("nxy") * F.pow(F.coalesce(F.col("mx"), F.lit(0.0)) - F.col("MX"), 2)).alias("M2X"),
        F.collect_list(F.struct("n", "first_ord", "source")).alias("dist"),
    )
    of = names.groupBy(F.col("target").alias("_t")).agg(*[
        F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.col("value")))).alias(name)
        for kind, name in (("q", "queries"), ("t", "topics"))])
    none = F.array().cast("array<string>")
    agg = agg.join(of, F.col("target").eqNullSafe(F.col("_t")), "left").withColumns(
        {c: F.coalesce(c, none) for c in ("queries", "topics")})

    has_sent = (F.col("n_sent") > 0) & (F.col("W") > 0)
    sentiment_avg = F.when(has_sent, F.round(F.col("mu"), 6))
    sentiment_std = F.when(has_sent & (F.col("n_sent") >= 2),
                           F.round(F.sqrt(F.greatest(F.lit(0.0), F.try_divide(F.col("M2"), F.col("W")))), 6))
    trust = F.round(F.coalesce(F.try_divide(F.col("trust_num"), F.col("trust_den")),
                               F.try_divide(F.col("all_num"), F.col("record_count"))), 6)
    recency = F.when(F.col("nd") > 0, F.round(F.try_divide(F.col("decay_sum"), F.col("nd")), 6)) \
               .otherwise(F.lit(0.0))
    n = F.col("record_count").cast("double")
    volume = F.when(n > 0, F.round(F.log1p(n) / (F.log1p(n) + F.log1p(F.lit(float(sp.volume_halfsat)))), 6)) \
              .otherwise(F.lit(0.0))
    slope = F.try_divide(F.col("CXY"), F.col("M2X"))
    trend = (F.when(F.col("nxy") < sp.min_records_for_trend, F.lit("unknown"))
              .when(F.col("M2X") == 0, F.lit("stable"))
              .when(slope > sp.trend_threshold, F.lit("up"))
              .when(slope < -sp.trend_threshold, F.lit("down"))
              .otherwise(F.lit("stable")))
    dist = F.transform(
        F.array_sort("dist", lambda a, b: F.when(a["n"] > b["n"], -1).when(a["n"] < b["n"], 1)
                     .when(a["first_ord"] < b["first_ord"], -1).when(a["first_ord"] > b["first_ord"], 1)
                     .otherwise(0)),
        lambda e: F.struct(e["source"].alias("source"), e["n"].alias("count")))

    out = agg.select(
        F.col("target").alias("entity"),
        "queries", "topics",
        F.col("record_count").cast("bigint").alias("record_count"),
        F.when(has_sent, F.col("n_sent")).otherwise(F.lit(0)).cast("bigint").alias("records_with_sentiment"),
        dist.alias("source_distribution"),
        sentiment_avg.alias("sentiment_avg"),
        sentiment_std.alias("sentiment_std"),
        trust.alias("source_trust_avg"),
        recency.alias("recency_score"),
        volume.alias("volume_score"),
        trend.alias("trend"),
        F.col("date_from"), F.col("date_to"),
    )
    wts = sp.weights
    unit = F.coalesce((F.col("sentiment_avg") + 1.0) / 2.0, F.lit(0.5))
    score = (F.lit(wts.get("sentiment", 0.0)) * unit
             + F.lit(wts.get("trust", 0.0)) * F.col("source_trust_avg")
             + F.lit(wts.get("recency", 0.0)) * F.col("recency_score")
             + F.lit(wts.get("volume", 0.0)) * F.col("volume_score"))
    out = out.withColumn("reputation_score",
                         F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), 4))
    out = out.withColumn("date_range", F.when(F.col("date_from").isNotNull(),
                                              F.struct(F.col("date_from").alias("from"),
                                                       F.col("date_to").alias("to"))))
    computed_at = sp.computed_at or f"{sp.as_of}T00:00:00Z"
    return out.withColumn("computed_at", F.lit(computed_at))


def flat_summary(summary: DataFrame) -> DataFrame:
    """Summary with list/struct fields rendered as delimited strings.

    Used for engine-neutral comparisons (``|`` between list items,
    ``source:count`` pairs joined by ``,``).
    """
    return summary.select(
        "entity",
        F.array_join("queries", "|").alias("queries"),
        F.array_join("topics", "|").alias("topics"),
        "record_count", "records_with_sentiment",
        F.array_join(F.transform("source_distribution",
                                 lambda e: F.concat(e["source"], F.lit(":"), e["count"].cast("string"))),
                     ",").alias("source_distribution"),
        "sentiment_avg", "sentiment_std", "source_trust_avg", "recency_score",
        "volume_score", "reputation_score", "trend", "date_from", "date_to",
    )
