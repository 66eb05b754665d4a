"""Order MinHash document fingerprints.

Every k-mer of code points is numbered by its occurrence (first, second,
... of the same k-mer), so repeats count.  A hash deals the numbered
k-mers into ``sketches`` bins; a bin keeps its ``tuple_size`` smallest,
puts them back into text order, and hashes their tuple.  Equal tuples need
the same k-mers in the same order, which makes the share of equal bins
sensitive to edit distance and not only to the set of k-mers.  Bins that
stay empty take the tuple of the next filled bin, tagged by the distance.

Defined results: null and empty texts have the same fingerprint, all
zeros; a text shorter than k is a single k-mer; equal texts have equal
fingerprints; likeness is the share of equal places, 1 for equal texts.
In ``edited_pairs`` rows follow each other by descending doc_id, null ids
last, ties by text hash then text; a single row is its own next document.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K, SKETCHES, TUPLE = 8, 32, 2
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def kmer_hashes(points: np.ndarray, k: int = K) -> np.ndarray:
    """Hash of every k-mer, by its code points from left to right."""
    n = max(1, len(points) - k + 1)
    h = np.zeros(n, np.uint64)
    for i in range(min(k, len(points))):
        h = h * np.uint64(0x100000001B3) + points[i:i + n] + np.uint64(1)
    return _mix(h)


def occurrence_numbers(h: np.ndarray) -> np.ndarray:
    """0 for the first of equal values, 1 for the second, ... in order."""
    out = np.zeros(len(h), np.uint64)
    by = np.sort(h)
    twice = np.unique(by[1:][by[1:] == by[:-1]])
    if not len(twice):
        return out
    at = np.searchsorted(twice, h)
    again = np.nonzero(twice[np.minimum(at, len(twice) - 1)] == h)[0]
    group = at[again]
    order = np.argsort(group, kind="stable")
    sizes = np.bincount(group)
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[again[order]] = np.arange(len(again)) - first
    return out


def sketch(text: str, k: int = K, sketches: int = SKETCHES, size: int = TUPLE) -> np.ndarray:
    """The fingerprint: one 32-bit tuple hash per bin."""
    points = _points(text)
    if not len(points):
        return np.zeros(sketches, np.uint32)
    base = kmer_hashes(points, k)
    rank = _mix(base + occurrence_numbers(base) * _MIX)
    places = np.arange(len(rank))
    often = 16 * sketches * size
    if len(rank) > 4 * often:  # the smallest are among those below a bound, unless a bin stays short
        low = np.nonzero(rank < np.uint64(int(often / len(rank) * 2.0**64)))[0]
        bins = (rank[low] & np.uint64(sketches - 1)).astype(np.int64)
        if len(low) and np.bincount(bins, minlength=sketches).min() >= size:
            places, rank = low, rank[low]
    bins = (rank & np.uint64(sketches - 1)).astype(np.int64)
    order = np.lexsort((rank, bins))
    bins, places = bins[order], places[order]
    sizes = np.bincount(bins, minlength=sketches)
    starts = np.cumsum(sizes) - sizes
    at = (np.cumsum(sizes) - sizes)[:, None] + np.arange(size)
    chosen = np.where(np.arange(size) < sizes[:, None], places[np.minimum(at, len(places) - 1)], len(base))
    chosen.sort(axis=1)  # back into text order; places that a short bin lacks come last
    grams = np.append(base, np.uint64(0))[chosen]
    out = np.minimum(sizes, size).astype(np.uint64)
    for i in range(size):
        out = _mix(out * _MIX + grams[:, i])
    filled = np.nonzero(sizes)[0]
    for_each = filled[np.searchsorted(filled, np.arange(sketches)) % len(filled)]
    ahead = (for_each - np.arange(sketches)) % sketches
    out = np.where(ahead > 0, _mix(out[for_each] + ahead.astype(np.uint64) * _MIX), out)
    return (out >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def to_text(s: np.ndarray) -> str:
    return s.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.mean(a == b))


def fingerprint_documents(docs: DataFrame, k: int = K, sketches: int = SKETCHES, size: int = TUPLE) -> DataFrame:
    """doc_id and fingerprint (hex, eight digits for each bin) of every row; ``sketches`` is a power of two."""
    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"),
                                "fingerprint": [to_text(sketch(t or "", k, sketches, size)) for t in pdf["text"]]})

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInPandas(run, "doc_id long, fingerprint string")


def _dealt(docs: DataFrame, parts: int) -> DataFrame:
    """doc_id, text, h, part, head: rows dealt into ranges of descending doc_id.

    Each part also gets a copy (``head``) of the first row of the part
    that follows, the last one of the first row of all.  Rows without an
    id are dealt by their text hash.  Only the range bounds and the largest
    id of each part, a few values per part, pass through the driver.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / parts for i in range(parts)], 100 * parts)).first()[0]
    cuts = sorted(set(cuts or []), reverse=True)
    nulls = len(cuts) + 9 + F.shiftright("h", 60)
    part = F.size(F.filter(F.lit(cuts) if cuts else F.array().cast("array<bigint>"), lambda c: c > F.col("doc_id")))
    rows = rows.withColumn("h", F.xxhash64("text")).withColumn(
        "part", F.when(F.col("doc_id").isNull(), nulls).otherwise(part).cast("int"))
    tops = {r.part: r.top for r in rows.groupBy("part").agg(F.max("doc_id").alias("top")).collect()}
    order = sorted(tops)
    if not order:
        return rows.withColumn("head", F.lit(False))
    before = F.create_map(*[F.lit(x) for a, b in zip(order, order[1:] + order[:1]) for x in (b, a)])
    top = F.create_map(*[x for p in order for x in (F.lit(p), F.lit(tops[p]).cast("long"))])[F.col("part")]
    heads = (rows.filter(F.col("doc_id").eqNullSafe(top)).groupBy("part")
             .agg(F.min(F.struct("h", "text")).alias("x"))
             .select(F.lit(None).cast("long").alias("doc_id"), "x.text", "x.h", before[F.col("part")].alias("part"),
                     F.lit(True).alias("head")))
    return rows.withColumn("head", F.lit(False)).unionByName(heads)


def edited_pairs(docs: DataFrame, k: int = K, sketches: int = SKETCHES, size: int = TUPLE) -> DataFrame:
    """Every document against its edited text and the next document by descending doc_id.

    The edited text has its last third replaced by the first characters of
    the next document.  Whole texts are shuffled once; a task walks its
    sorted ranges and keeps two texts at a time.
    """
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def compare(batches):
        def row(doc_id, text, print_, after, after_print):
            n = len(text)
            m = n // 3
            edited = text[:n - m] + after[:m]
            ep = sketch(edited, k, sketches, size)
            sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
            return (doc_id, n, sha, to_text(print_), to_text(ep), likeness(print_, ep), likeness(print_, after_print))

        held = None
        for pdf in batches:
            out = []
            for doc_id, text, part, head in zip(pdf["doc_id"].astype("Int64"), pdf["text"], pdf["part"], pdf["head"]):
                print_ = sketch(text, k, sketches, size)
                if held is not None:
                    out.append(row(*held, text, print_))
                held = None if head else (doc_id, text, print_)
            yield pd.DataFrame(out, columns=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                                             "near_edited", "near_next"]).astype({"doc_id": "Int64"})

    dealt = _dealt(docs, 4 * parts).repartition(parts, "part").sortWithinPartitions(
        "part", "head", F.col("doc_id").desc_nulls_last(), "h", "text")
    return dealt.select("doc_id", "text", "part", "head").mapInPandas(
        compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                 "near_edited double, near_next double")
