"""Row filters (``DataFrame -> DataFrame``), all plain predicates.

They are stateless, so they work unchanged on streaming DataFrames and
push down into scans where the predicate allows it.  Removed-row counts
are collected with ``DataFrame.observe`` (no extra job).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from renown import params as P
from renown.functions.text import keyword_relevant


def quality_predicate(blocked: Iterable[str] = P.BLOCKED_DOMAINS,
                      min_text: int = P.MIN_TEXT_LENGTH,
                      min_title: int = P.MIN_TITLE_LENGTH) -> Column:
    domain = F.coalesce(F.col("domain"), F.lit(""))
    blocked_hit = (domain != "") & domain.isin(sorted(blocked))
    text_len = F.length(F.coalesce(F.col("text"), F.lit("")))
    title_len = F.length(F.coalesce(F.col("title"), F.lit("")))
    return ~blocked_hit & ((text_len >= min_text) | (title_len >= min_title))


def filter_quality(df: DataFrame, blocked: Iterable[str] = P.BLOCKED_DOMAINS,
                   min_text: int = P.MIN_TEXT_LENGTH, min_title: int = P.MIN_TITLE_LENGTH) -> DataFrame:
    """Drop blocked domains and rows whose text AND title are both too short."""
    return df.where(quality_predicate(blocked, min_text, min_title))


def filter_by_date(df: DataFrame, since: str | None) -> DataFrame:
    """Keep date >= since; NULL (including unparseable) dates are kept."""
    if not since:
        return df
    P.parse_since(since)
    return df.where(F.col("date").isNull() | (F.col("date") >= F.lit(since).cast("date")))


def filter_by_language(df: DataFrame, languages: Iterable[str] | None) -> DataFrame:
    """Keep NULL language or lower(language) in the trimmed, lower-cased set."""
    allowed = sorted({x.strip().lower() for x in (languages or [])})
    if not allowed:
        return df
    return df.where(F.col("language").isNull() | F.lower(F.col("language")).isin(allowed))


def filter_relevant(df: DataFrame, query_col: str = "query", title_col: str = "title",
                    description_col: str = "description", min_term_len: int = 2) -> DataFrame:
    """Keep items where any query term longer than ``min_term_len`` occurs."""
    return df.where(keyword_relevant(query_col, title_col, description_col, min_term_len))


def observed_count(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows flowing through ``df`` as a side metric of the next action."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("n")), obs
