"""Removal of byte strings that occur more than once, by names of growing length.

A name is a hash of the string that starts at a position.  Names of length
2h come from the pair of names at a position and h further on, so inside a
document names double without any exchange: 1, 2, 4, ... bytes.  Anchors and
hash groups take the place of ranks sorted by Spark at every doubling (README
says why): Spark groups positions by their names at three growing lengths, and
only positions whose name is not unique go on:

1. Anchors.  Every ``length``-byte window contains ``length - GRAM + 1``
   strings of GRAM (half the length) bytes; the one with the smallest name,
   leftmost on ties, is its anchor and depends on the window's bytes
   alone.  Neighbouring windows with the same anchor form a run.  A run
   whose anchor name is unique cannot repeat and is dropped; runs that are
   equal as a whole repeat as a whole.
2. Blocks of 16 windows, aligned to the anchor, of one run per different
   whole: the bytes that all 16 share are the name to group by.
3. Single windows of the blocks that are still undecided.

A window found equal to another one at any step covers its bytes.  Names
that decide are 128 bits long (pairs of 64); 64 bits group candidates.

Groups are counted by partial aggregation, so a string on a third of all
rows is one row per task; nothing is compared pair by pair.  Texts are
joined twice, by id and text hash (repeated rows share their results): to
get the bytes of the undecided runs, and to cut the final ranges out.

Defined results: null is empty; a text shorter than ``length`` loses
nothing; repeated rows repeat each other's strings; positions are bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renown.llm.common import doc_key
from renown.session import discard, materialize, shuffles_freed

BLOCK = 16
_A = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_NAMES = _mix(np.arange(1, 257, dtype=np.uint64) * _A)


def names(data: np.ndarray, length: int) -> np.ndarray:
    """Name of the string of ``length`` bytes at every position that has one."""
    h, m = _BYTE_NAMES[data], 1
    while 2 * m <= length:
        h, m = _mix(h[:-m] * _A + h[m:]), 2 * m
    if m < length:  # the last pair overlaps
        h = _mix(h[:len(h) - (length - m)] * _A + h[length - m:])
    return h


def _window_min(h: np.ndarray, w: int) -> np.ndarray:
    m = 1
    while 2 * m <= w:
        h, m = np.minimum(h[:-m], h[m:]), 2 * m
    return h if m == w else np.minimum(h[:len(h) - (w - m)], h[w - m:])


def runs(raw: bytes, length: int, piece: int = 1 << 20):
    """(start, windows, anchor position, anchor name) of the runs of a text; memory is bounded by ``piece``."""
    data, gram = np.frombuffer(raw, np.uint8), length // 2
    w, last = length - gram + 1, len(raw) - length + 1
    held = None
    for at in range(0, max(0, last), piece):
        g = names(data[at:at + piece + length - 1], gram)
        low = _window_min(g, w)
        ends = np.append(np.nonzero(low[1:] != low[:-1])[0] + 1, len(low)).tolist()
        s = 0
        for e in ends:
            while s < e:
                m = s + int(g[s:s + w].argmin())
                stop = min(e, m + 1)
                now = (at + s, stop - s, at + m, int(low[s]))
                if held is not None and held[2] == now[2]:  # cut by the piece's end
                    held = (held[0], held[1] + now[1], held[2], held[3])
                else:
                    if held is not None:
                        yield held
                    held = now
                s = stop
    if held is not None:
        yield held


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _whole(raw: bytes, a: int, b: int, offset: int) -> tuple[int, int]:
    """Two 64-bit halves of the name of raw[a:b] at a distance from its anchor."""
    v = xxhash.xxh3_128_intdigest(raw[a:b], offset & 0xFFFFFFFF)
    return _signed(v >> 64), _signed(v & 0xFFFFFFFFFFFFFFFF)


_ITEM = "k1 long, k2 long, run int, start int, n int, anchor int, c long, f1 long, f2 long"
_RUN = "k1 long, k2 long, run int, start int, n int, anchor int, raw binary"


def _frame(rows, schema=_ITEM):
    return pd.DataFrame(rows, columns=[x.split()[0] for x in schema.split(", ")])


def _first_items(texts: DataFrame, length: int) -> DataFrame:
    def make(batches):
        for pdf in batches:
            rows = []
            for k1, k2, text in zip(pdf["k1"], pdf["k2"], pdf["text"]):
                raw = text.encode()
                for s, n, m, c in runs(raw, length):
                    rows.append((k1, k2, s, s, n, m, _signed(c), *_whole(raw, s, s + n - 1 + length, m - s)))
                if len(rows) > 200_000:
                    yield _frame(rows)
                    rows = []
            yield _frame(rows)

    return texts.mapInPandas(make, _ITEM)


def _run_bytes(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The wanted runs with their bytes (under twice ``length`` each)."""
    lists = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "n", "anchor")).alias("items"))

    def make(batches):
        for pdf in batches:
            rows = []
            for k1, k2, text, items in zip(pdf["k1"], pdf["k2"], pdf["text"], pdf["items"]):
                raw = text.encode()
                rows += [(k1, k2, it["start"], it["start"], it["n"], it["anchor"],
                          raw[it["start"]:it["start"] + it["n"] - 1 + length]) for it in items]
            yield _frame(rows, _RUN)

    lists = materialize(lists, "suffix-lists")  # the same plan at every size; hot keys can be split
    held = texts.join(lists.hint("merge"), ["k1", "k2"]).select("k1", "k2", "text", "items").mapInPandas(make, _RUN)
    held = materialize(held, "suffix-bytes")
    discard(lists)
    return held


def _finer_items(held: DataFrame, length: int, block: int) -> DataFrame:
    """Blocks of ``block`` windows, aligned to the anchors, of the runs or parts of runs in ``held``."""
    def make(batches):
        for pdf in batches:
            rows = []
            for k1, k2, run, s, n, m, raw in pdf[[x.split()[0] for x in _RUN.split(", ")]].itertuples(index=False):
                p, end = s, s + n
                while p < end:
                    first = m + (p - m) // block * block
                    stop = min(end, first + block)
                    core = _signed(xxhash.xxh3_64_intdigest(raw[first + block - 1 - run:first + length - run]))
                    rows.append((k1, k2, run, p, stop - p, m, core,
                                 *_whole(raw, p - run, stop - 1 + length - run, p - first)))
                    p = stop
                if len(rows) > 200_000:
                    yield _frame(rows)
                    rows = []
            yield _frame(rows)

    return held.mapInPandas(make, _ITEM)


def _settle(items: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(repeated, undecided) of written items: equal wholes repeat; one item per whole of groups with several goes on.

    Each table is deleted, the items included, once those that read it are written.
    """
    again = materialize(items.groupBy("c").agg(F.count("*").alias("n")).filter("n > 1").select("c"), f"{name}-groups")
    kept = materialize(items.join(again, "c", "left_semi"), f"{name}-kept")
    for read in (items, again):
        discard(read)
    place = ["k1", "k2", "run", "start", "n", "anchor"]
    one = [F.first(x).alias(x) for x in place]  # of the same row
    wholes = materialize(kept.groupBy("c", "f1", "f2").agg(F.count("*").alias("copies"), *one), f"{name}-wholes")
    repeated = kept.join(wholes.filter("copies > 1").select("c", "f1", "f2"), ["c", "f1", "f2"], "left_semi")
    repeated = materialize(repeated.select("k1", "k2", "start", "n"), f"{name}-repeated")
    several = materialize(wholes.groupBy("c").agg(F.count("*").alias("m")).filter("m > 1").select("c"), f"{name}-several")
    undecided = materialize(wholes.join(several, "c", "left_semi").select(*place), f"{name}-undecided")
    for read in (kept, wholes, several):
        discard(read)
    return repeated, undecided


def repeated_windows(docs: DataFrame, length: int = 400) -> DataFrame:
    """(k1, k2, start, n): runs of n windows that each occur somewhere else too."""
    texts = docs.select(*doc_key(), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.filter(F.octet_length("text") >= length)
    first, runs_left = _settle(materialize(_first_items(texts, length), "suffix-runs"), "suffix-run")
    held = _run_bytes(texts, runs_left, length)
    second, blocks_left = _settle(materialize(_finer_items(held, length, BLOCK), "suffix-blocks"), "suffix-block")
    parts = blocks_left.join(held.select("k1", "k2", "run", "raw"), ["k1", "k2", "run"])
    items = materialize(_finer_items(parts, length, 1), "suffix-windows")
    for read in (runs_left, blocks_left, held):
        discard(read)
    third, windows_left = _settle(items, "suffix-window")
    discard(windows_left)
    return first.unionByName(second).unionByName(third)


def remove_repeats(docs: DataFrame, length: int = 400, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and spans (byte ranges) of every row."""
    with shuffles_freed(docs.sparkSession):
        found = repeated_windows(docs, length)
        spans = found.groupBy("k1", "k2").agg(F.sort_array(F.collect_set(F.struct(
            F.col("start").alias("s"), (F.col("start") + F.col("n") + (length - 1)).alias("e")))).alias("ranges"))
        spans = materialize(spans, "suffix-spans").hint("merge")
    discard(found)

    def cut(batches):
        for pdf in batches:
            rows = []
            for doc_id, text, ranges in zip(pdf["doc_id"].astype("Int64"), pdf["text"], pdf["ranges"]):
                raw, merged = (text or "").encode(), []
                for r in ranges if ranges is not None else ():
                    if merged and r["s"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], r["e"])
                    else:
                        merged.append([r["s"], r["e"]])
                edges = [0, *[x for r in merged for x in r], len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
                rows.append((doc_id, len(raw), len(raw) - len(kept), len(merged), hashlib.sha256(kept).hexdigest(),
                             [(a, b) for a, b in merged], kept.decode("utf-8", "replace") if with_text else None))
            yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
                               ).astype({"doc_id": "Int64"})

    rows = docs.select(*doc_key(), F.col("doc_id").cast("long"), "text").join(spans, ["k1", "k2"], "left")
    return rows.select("doc_id", "text", "ranges").mapInPandas(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
             "spans array<struct<s:long,e:long>>, kept string")


def repeats_report(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).drop("spans", "kept")
