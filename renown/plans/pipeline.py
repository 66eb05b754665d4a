"""The whole batch run as one composition of DataFrame -> DataFrame steps.

raw (landed) -> normalize -> accepted -> clean -> quality -> since
-> first-wins dedup -> enrich -> language filter -> summary (+ sinks)

Three stage boundaries are materialised as Parquet in
``spark.checkpoint.dir``: the normalised rows (accepted + rejects, so the
JSON parsing runs once and the rejects table is available), the
cleaned, filtered records that dedup both keys and joins back to (so
cleaning's Python UDF is not evaluated twice) and the final records that
the summary and the sinks read.  Dedup iterates over the
narrow (ord, keys) projection.  Step counters are ``Observation`` metrics
collected by the actions that run anyway.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from renown import params as P
from renown.operators.clean import clean_records
from renown.operators.dedup import deduplicate
from renown.operators.enrich import LanguageModel, Scorer, enrich
from renown.operators.filters import filter_by_date, filter_by_language, filter_quality, observed_count
from renown.operators.normalize import accepted, normalize, rejects
from renown.session import ensure_checkpoint_dir, materialize
from renown.operators.summary import reputation_summary


@dataclass
class RunResult:
    records: DataFrame
    summary: DataFrame
    counters: dict[str, Observation] = field(default_factory=dict)
    rejects: DataFrame | None = None

    def counts(self) -> dict[str, int]:
        """Rows after each step; the enrichment adds with_language and with_sentiment."""
        out = {}
        for k, o in self.counters.items():
            metrics = o.get
            out[k] = int(metrics.get("n", metrics.get("rows", 0)))
            out.update({m: int(v) for m, v in metrics.items() if m.startswith("with_")})
        return out


def run_pipeline(raw: DataFrame, since: str | None = None, languages: tuple[str, ...] = (),
                 sources: tuple[str, ...] = (), as_of: str = "2024-12-31",
                 language_model: LanguageModel | None = None, scorer: Scorer | None = None) -> RunResult:
    if sources:
        unknown = [s for s in sources if s not in P.SOURCE_ORDER]
        if unknown:
            raise ValueError(f"unknown sources: {unknown}")
        raw = raw.where(F.col("source").isin(*sources))
    ensure_checkpoint_dir(raw.sparkSession)
    counters: dict[str, Observation] = {}
    norm = normalize(raw)
    # the payload is only kept as evidence on rejected rows: accepted rows do not
    # rewrite the raw data
    norm = materialize(norm.withColumn("payload", F.when(F.col("reject_reason").isNotNull(), F.col("payload"))),
                       "normalized")
    recs = accepted(norm)
    recs, counters["normalized"] = observed_count(recs, "normalized")
    recs = clean_records(recs)
    recs = filter_quality(recs)
    recs, counters["after_quality"] = observed_count(recs, "after_quality")
    recs = filter_by_date(recs, since)
    recs, counters["after_since"] = observed_count(recs, "after_since")
    recs = deduplicate(materialize(recs, "filtered-records"))
    recs, counters["after_dedup"] = observed_count(recs, "after_dedup")
    recs, counters["enriched"] = enrich(recs, language_model, scorer, observe=True)
    recs = filter_by_language(recs, languages)
    recs, counters["after_language"] = observed_count(recs, "after_language")
    recs = materialize(recs, "records")  # evaluated once for the summary and the sinks
    summary = reputation_summary(recs, P.SummaryParams(as_of=as_of))
    return RunResult(recs, summary, counters, rejects(norm))


def scan_selected(responses: DataFrame, params: P.RunParams,
                  redirects: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(ordered raw rows, rejected responses) of what ``params`` selects of the landed responses.

    Source selection (empty = every source except the opt-in ones; the
    filter prunes a source-partitioned landing table), the scans of
    ``sources.mixed`` with ``max_results`` (1 in a dry run) and deterministic
    ``ord`` from the (source, query) task order.
    """
    from renown.sources.landed import SCAN_RULES, require_distinct_responses, with_order
    from renown.sources.mixed import scan_run

    resp = responses.where(F.col("target") == params.target) \
                    .where(F.col("source").isin(*params.selected_sources)) \
                    .where(F.col("query").isin(*params.queries))
    require_distinct_responses(resp)
    raw, bad = scan_run(resp, list(params.queries), params.effective_max_results, slice_all=params.dry_run,
                        redirects=redirects, as_of=params.as_of, max_videos=params.max_videos,
                        languages=params.page_languages)
    return with_order(raw, list(params.queries), sources=tuple(dict.fromkeys([*P.SOURCE_ORDER, *SCAN_RULES]))), bad


def run_from_responses(responses: DataFrame, params: P.RunParams, redirects: DataFrame | None = None,
                       language_model: LanguageModel | None = None, scorer: Scorer | None = None) -> RunResult:
    """A whole run from landed responses of any source, driven by ``RunParams``.

    ``scan_selected``, then ``run_pipeline``.  ``redirects`` (link, final_url)
    resolves feed links.  Unreadable and error responses and halves of talk
    pages join the rejects.
    """
    raw, bad = scan_selected(responses, params, redirects)
    res = run_pipeline(raw, since=params.since, languages=params.languages, as_of=params.as_of,
                       language_model=language_model, scorer=scorer)
    res.rejects = res.rejects.unionByName(bad, allowMissingColumns=True)
    return res
