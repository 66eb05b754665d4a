"""Exact first-wins deduplication over two keys, and first-wins per key.

Sequential semantics (what must be reproduced): scan rows in ``ord``
order; drop a row if its url key was already *kept*, or if its
(title, domain) key was already *kept*; keys of dropped rows are not
remembered.  That is the lexicographically-first maximal independent set
of the "shares a key" graph, which two ``dropDuplicates`` passes do not
compute (A(u1,t1), B(u2,t1), C(u2,t3) keeps A and C).

Rows conflict inside one target only: a run handles one target at a
time, so both keys lead with the target (rows without one share a target).

Distributed form -- rounds of:

1. ``min(ord)`` per key over the undecided rows (``groupBy`` with map-side
   partial aggregation: a key holding a third of all rows costs one partial
   row per task, not one task);
2. a row that is the minimum of *all* its keys has no undecided earlier
   neighbour, so it is kept.  Counting how many keys each minimum holds
   tells that without a join back to the rows;
3. the keys of kept rows are written (one row per key) and the undecided
   rows that hold one of them are decided.  Both sides of that join come
   from files and a shuffle, so AQE can split a hot key.  A row without a
   key takes part under a filler made of its own ``ord``, which spreads
   NULL keys over all tasks and matches nothing.

Every round keeps at least the smallest undecided ``ord`` so the loop
terminates; rows whose keys are unique finish in round 1 and later
rounds only see the conflicting residue.  Each round's residue is written
as Parquet below ``spark.checkpoint.dir`` and removed once the next is
there.  Only the narrow (ord, keys) projection is iterated; the wide
records are joined back once at the end.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renown import params as P
from renown.functions.text import py_strip
from renown.functions.urls import canonical_title, canonical_url
from renown.session import discard, materialize

log = logging.getLogger(__name__)

_KEY_SEP = "\u0001"


def url_key(url="url", source="source") -> Column:
    preserve = F.col(source).isin(sorted(P.FRAGMENT_PRESERVING_SOURCES))
    k = canonical_url(url, preserve)
    return F.when(k != "", k)


def title_domain_key(title="title", domain="domain", source="source") -> Column:
    tk = canonical_title(title)
    dk = py_strip(F.lower(F.coalesce(F.col(domain), F.lit(""))))
    skip = F.col(source).isin(sorted(P.TITLE_DEDUP_EXCLUDED_SOURCES))
    return F.when(~skip & (tk != "") & (dk != ""), F.concat(tk, F.lit(_KEY_SEP), dk))


def with_dedup_keys(df: DataFrame) -> DataFrame:
    """Adds ``_uk`` and ``_tk``, led by the target where the rows have one."""
    uk, tk = url_key(), title_domain_key()
    if "target" in df.columns:
        lead = F.concat(F.coalesce(F.col("target"), F.lit("")), F.lit(_KEY_SEP))
        uk, tk = F.concat(lead, uk), F.concat(lead, tk)
    return df.withColumn("_uk", uk).withColumn("_tk", tk)


def _undecided(res: DataFrame, taken: DataFrame) -> DataFrame:
    """Rows of ``res`` that hold none of the ``taken`` keys."""
    for col in ("uk", "tk"):
        filler = F.concat(F.lit(_KEY_SEP * 3), F.col("ord").cast("string"))
        res = res.withColumn("_k", F.coalesce(F.col(col), filler)).join(
            taken.withColumnRenamed("key", "_k"), "_k", "left_anti").drop("_k")
    return res


def first_wins_ords(keyed: DataFrame, ord_col: str = "ord", uk: str = "_uk", tk: str = "_tk",
                    max_rounds: int | None = None) -> tuple[DataFrame, int]:
    """Ords of the rows the sequential two-key first-wins scan keeps.

    ``keyed`` holds (ord, uk, tk); ``ord`` is unique; NULL keys never
    conflict.  Returns (DataFrame[ord], rounds used).  ``max_rounds`` only
    guards against a runaway; hitting it raises instead of returning a
    partial answer.
    """
    narrow = keyed.select(F.col(ord_col).alias("ord"), F.concat(F.lit("u"), uk).alias("uk"),
                          F.concat(F.lit("t"), tk).alias("tk"))
    res = materialize(narrow, "dedup-rows")
    parts = [res.where("uk IS NULL AND tk IS NULL").select("ord")]
    first, rounds = res, 0
    while res.where("uk IS NOT NULL OR tk IS NOT NULL").take(1):
        rounds += 1
        if max_rounds is not None and rounds > max_rounds:
            raise RuntimeError(f"first-wins dedup did not converge in {max_rounds} rounds")
        keys = F.array_compact(F.array("uk", "tk"))
        mins = res.select(F.struct("ord", F.size(keys).alias("n")).alias("row"), F.explode(keys).alias("key")) \
                  .groupBy("key").agg(F.min("row").alias("row"))
        kept = mins.groupBy("row").agg(F.count(F.lit(1)).alias("mins"), F.collect_list("key").alias("keys")) \
                   .where(F.col("mins") == F.col("row.n"))        # a row has two keys at most
        kept = materialize(kept.select("row.ord", "keys"), "dedup-kept")
        parts.append(kept.select("ord"))
        before, res = res, materialize(
            _undecided(res.where("uk IS NOT NULL OR tk IS NOT NULL"), kept.select(F.explode("keys").alias("key"))),
            "dedup-rows")
        if before is not first:
            discard(before)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    log.info("first-wins dedup finished in %d rounds", rounds)
    return out, rounds


def deduplicate(df: DataFrame, ord_col: str = "ord") -> DataFrame:
    """Unique records of each target under the two-key first-wins rule."""
    keyed = with_dedup_keys(df).select(ord_col, "_uk", "_tk")
    kept, _ = first_wins_ords(keyed, ord_col)
    return df.join(kept.withColumnRenamed("ord", ord_col), ord_col, "left_semi")


def first_per_key(df: DataFrame, keys: list[str], ord_col: str = "ord") -> DataFrame:
    """Keep the earliest row (by ``ord_col``) of each key group.

    ``min`` per key with map-side combine, then a semi join back on
    (keys, ord) -- no window holding a whole hot group in one task.
    NULL key values form their own group (null-safe equality).
    """
    firsts = df.groupBy(*keys).agg(F.min(ord_col).alias("_first")).alias("_f")
    a = df.alias("_a")
    cond = [F.col(f"_a.{k}").eqNullSafe(F.col(f"_f.{k}")) for k in keys]
    cond.append(F.col(f"_a.{ord_col}") == F.col("_f._first"))
    return a.join(firsts, cond, "left_semi")
