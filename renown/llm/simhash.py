"""SimHash near-dedup over a byte-position inverted index with count filtering.

Two 64-bit fingerprints that differ in at most ``max_bits`` (4) bits agree
in at least four of their eight bytes.  Every fingerprint is posted under
each choice of four byte positions with its bytes there, so a pair meets
in every list for which it shares all four; within a list the shared
positional bytes of every pair are tallied first, and a pair that reaches
the guaranteed count is a candidate only in the list of its first four
shared positions.  Candidates are verified by their differing bits.

Lists with more than ``block`` fingerprints are dealt into blocks, and a
task gets two blocks at a time, so no list has to fit one task and no pair
is left out.  A task returns the links of a spanning forest of what it
verified, never all pairs.  Only different fingerprints are compared:
copies meet in the fingerprint table before.

Defined results: null or empty text, or one without words, has fingerprint
zero, linked like any other; a text of fewer words than the shingle is one
shingle; repeated rows are linked to each other; the component of rows
that all have a null doc_id is null; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renown.llm.common import connected_components, doc_key, without
from renown.session import materialize

BYTES, SEED = 8, 42


def shingle_hashes(text: str | None, words_each: int) -> np.ndarray:
    """XXH64 of every shingle of a text, repeats included."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space alone
    if not words:
        return np.zeros(0, np.uint64)
    joined, h = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= words_each:
        return np.array([h(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = len(words) - words_each + 1
    return np.fromiter((h(joined[a:b], SEED) for a, b in zip(starts[:last].tolist(), ends[words_each - 1:].tolist())),
                       np.uint64, last)


def fingerprint(hashes: np.ndarray, block: int = 1 << 16) -> int:
    """Bits that are set in over half the hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), block):
        part = hashes[at:at + block].astype("<u8").view(np.uint8).reshape(-1, BYTES)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words_each: int = 4) -> DataFrame:
    """doc_id, (k1, k2) and signed 64-bit fp of every row."""
    def run(batches):
        for pdf in batches:
            fp = np.array([fingerprint(shingle_hashes(t, words_each)) for t in pdf["text"]], np.uint64)
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "k1": pdf["k1"], "k2": pdf["k2"],
                                "fp": fp.view(np.int64)})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *doc_key(), "text")
    return rows.mapInPandas(run, "doc_id long, k1 long, k2 long, fp long")


_LOW7, _HIGH = np.uint64(0x7F7F7F7F7F7F7F7F), np.uint64(0x8080808080808080)


def _candidates(x: np.ndarray, positions: tuple[int, ...], need: int) -> np.ndarray:
    """Which XORs of pairs share at least ``need`` positional bytes, the first ``need`` of them at ``positions``."""
    differ = (((x & _LOW7) + _LOW7) | x) & _HIGH  # the high bit of each byte that differs
    enough = BYTES - np.bitwise_count(differ) >= need
    here = sum(0x80 << 8 * p for p in positions)
    before = sum(0x80 << 8 * p for p in range(positions[-1]) if p not in positions)
    return enough & (differ & np.uint64(here | before) == np.uint64(before))


def _forest(left: np.ndarray, right: np.ndarray | None, positions, need: int, max_bits: int, cells: int = 1 << 18):
    """Links (u, v) of a spanning forest of the verified pairs within ``left`` or between two blocks."""
    other, shift = (left, 0) if right is None else (right, len(left))
    root = np.arange(len(other) + shift)

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out, step = [], max(1, cells // max(1, len(other)))
    for at in range(0, len(left), step):
        x = left[at:at + step, None] ^ other[None, :]
        tallied = _candidates(x, positions, need)
        if right is None:
            tallied &= np.arange(at, at + len(x))[:, None] < np.arange(len(other))
        i, j = np.nonzero(tallied)
        near = np.bitwise_count(x[i, j]) <= max_bits
        for i, j in zip((i[near] + at).tolist(), j[near].tolist()):
            a, b = find(i), find(j + shift)
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((int(left[i]), int(other[j])))
    return out


def links(prints: DataFrame, max_bits: int = 4, block: int = 2048) -> DataFrame:
    """(u, v) links that connect what lies within ``max_bits`` bits; ``prints`` is a written table of distinct fp."""
    need = BYTES - max_bits
    if need < 1:
        raise ValueError("the byte index needs max_bits below 8")
    choices = list(combinations(range(BYTES), need))

    def value(c):
        return F.expr(" | ".join(f"(shiftright(fp, {8 * p}) & 255L) << {8 * i}" for i, p in enumerate(c)))

    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lists = prints.repartition(parts, "fp").select("fp", F.posexplode(F.array(*[value(c) for c in choices])).alias("choice", "bytes"))
    long = materialize(lists.groupBy("choice", "bytes").agg(F.count("*").alias("n")).filter(F.col("n") > block),
                       "simhash-long")
    blocks = F.coalesce(F.ceil(F.col("n") / block), F.lit(1)).cast("int")
    posted = (lists.join(long, ["choice", "bytes"], "left")
              .withColumn("blocks", blocks)
              .withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("choice", "bytes", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"),
                      "mine", "fp"))

    keys = ["choice", "bytes", "lo", "hi"]

    def joined(choice, lo, hi, mine, fp):
        if lo == hi:
            return _forest(fp, None, choices[choice], need, max_bits)
        return _forest(fp[mine == lo], fp[mine == hi], choices[choice], need, max_bits)

    def verify(batches):
        """Rows come sorted by list and block pair; the last list of a batch waits for the next one."""
        held = None
        for pdf in batches:
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            key = pdf[keys].to_numpy(np.int64)
            starts = np.append(0, np.nonzero((key[1:] != key[:-1]).any(axis=1))[0] + 1) if len(pdf) else np.zeros(1, int)
            held = pdf.iloc[starts[-1]:]
            yield _pairs(lists_of(pdf, key, starts))
        if held is not None and len(held) > 1:
            yield _pairs(lists_of(held, held[keys].to_numpy(np.int64), np.array([0, len(held)])))

    def lists_of(pdf, key, starts):
        mine, fp, out = pdf["mine"].to_numpy(), pdf["fp"].to_numpy(np.int64).view(np.uint64), []
        several = np.nonzero(np.diff(starts) > 1)[0]
        for a, b in zip(starts[several].tolist(), starts[several + 1].tolist()):
            choice, _, lo, hi = key[a].tolist()
            out += joined(choice, lo, hi, mine[a:b], fp[a:b])
        return out

    def _pairs(rows):
        return pd.DataFrame(np.array(rows, np.uint64).view(np.int64).reshape(-1, 2), columns=["u", "v"])

    return (posted.repartition(*keys).sortWithinPartitions(*keys)
            .select(*keys, "mine", "fp").mapInPandas(verify, "u long, v long"))


def near_duplicates(docs: DataFrame, words_each: int = 4, max_bits: int = 4) -> DataFrame:
    """doc_id, (k1, k2), fp, component (an fp) and component_id (the smallest doc_id reachable, itself included)."""
    rows = materialize(fingerprints(docs, words_each), "simhash-rows")
    prints = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-prints")
    parts = connected_components(links(prints.select("fp"), max_bits), "simhash")
    joined = prints.join(parts.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp"))
    joined = materialize(joined, "simhash-joined")
    least = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = materialize(joined.join(least, "component").select("fp", "component", "component_id"), "simhash-classes")
    return rows.join(classes, "fp")


def keep_one(docs: DataFrame, words_each: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest doc_id (null ids last), ties by text hash.

    Of rows with the same id and text one stays.
    """
    rows = materialize(near_duplicates(docs, words_each, max_bits), "simhash-groups")
    first = materialize(rows.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "k1", "k2")).alias("x"))
                        .select("component", "x.k1", "x.k2"), "simhash-first")
    keys = rows.groupBy("k1", "k2", "component").agg(F.count("*").alias("n"))
    keys = materialize(keys.join(first.withColumn("stays", F.lit(True)), ["component", "k1", "k2"], "left"), "simhash-keys")
    lost = materialize(keys.filter("stays IS NULL OR n > 1").select("k1", "k2"), "simhash-lost")
    again = materialize(keys.filter("stays AND n > 1").select("k1", "k2"), "simhash-again")
    k1, k2 = doc_key()
    copies = (docs.withColumns({"__k1": k1, "__k2": k2})
              .join(again.select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2")), ["__k1", "__k2"], "left_semi")
              .dropDuplicates(["__k1", "__k2"]).select(*[F.col(f"`{c}`") for c in docs.columns]))
    return without(docs, lost).unionByName(copies)


def near_duplicate_report(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                        "component_id")
