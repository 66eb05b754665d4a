"""Best-fit packing by linear grouping.

Documents become token ids and are cut at ``capacity``.  What is planned
is the histogram of piece lengths (at most ``capacity`` entries, whatever
the number of documents): large lengths are rounded up within groups of
equal cardinality, configurations of the few rounded sizes are chosen to
fill sequences, the actual lengths take the rounded places, and small
lengths go best-fit, largest first, into the space that is left.  The plan
is a list of runs -- "the pieces number r0..r1 of this length lie in
sequences s0.. at this offset" -- so every piece finds its place from its
length and its number among the pieces of that length.

Defined results: a null or empty text is its end id alone; repeated rows
are packed as often as they occur; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from renown.session import materialize, small_batches

PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, task int, nth long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII marks


def _lower(word: str) -> str:
    """Lower case of a word of letters as the tokenizer makes it; empty if that may differ or isn't one token."""
    if not word.isalpha():
        return ""
    low = word.lower()
    if word.isascii():
        return low
    plain = low.isalpha() and "\u03a3" not in word and is_normalized("NFC", word) and is_normalized("NFC", low)
    return low if plain else ""


class _WordIds(dict):
    """Ids (little-endian uint32 bytes) of texts without white space.

    ``learn`` encodes what is new in a block of documents together: words
    of letters or of ASCII marks alone are one pre-token each, so one call
    over many of them tells their ids apart.  Anything else is encoded by
    itself.  At most ``most`` words of the present and as many of the past
    are kept (about 170 bytes each); words in use move on from the past.
    """

    def __init__(self, tokenizer, most: int = 150_000):
        super().__init__()
        self.tokenizer, self.most, self.past = tokenizer, most, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.past.get(word)
        if ids is None:
            head = word.rstrip(_MARKS)
            low = _lower(head)
            if low and head != word and "<|" not in word:
                ids = self[low] + self[word[len(head):]]  # letters and the marks after them are separate tokens
            elif low and head == word != low:
                ids = self[low]
            else:
                ids = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()
        self[word] = ids
        return ids

    def learn(self, found: set[str], each: int = 500) -> None:
        if len(self) >= self.most:
            self.past = dict(self)
            self.clear()
        heads = {w: w.rstrip(_MARKS) for w in found if w not in self and w not in self.past}
        new = {w[len(h):] for w, h in heads.items() if h != w and "<|" not in w and (not h or h.isalpha())}
        new |= {low for low in map(_lower, set(heads.values())) if low}
        new = [w for w in new if w not in self and w not in self.past]
        groups = [new[at:at + each] for at in range(0, len(new), each)]
        for words in groups:
            enc = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
            of = np.array(enc.word_ids, dtype=np.int64)
            cuts = np.concatenate(([0], np.nonzero(np.diff(of))[0] + 1, [len(of)])) * 4
            if len(cuts) == len(words) + 1:  # else the library splits one of them; __missing__ takes them singly
                ids = np.array(enc.ids, dtype="<u4").tobytes()
                self.update(zip(words, [ids[a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist())]))


def _worker_words(tokenizer_path: str) -> _WordIds:
    """The word memory of this Python worker; the tasks that it runs one after another share it.

    Functions are shipped by value, so their globals are new in every task: the memory
    is an attribute of a module that lives as long as the worker.
    """
    import os
    import tokenizers
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    held = vars(tokenizers).setdefault("_renown_words", {})
    if tokenizer_path not in held:
        held.clear()
        held[tokenizer_path] = _WordIds(tokenizers.Tokenizer.from_file(tokenizer_path))
    return held[tokenizer_path]


_TRAILING = re.compile(rf"[{re.escape(_MARKS)}](?<=[^\W_].)[{re.escape(_MARKS)}]*(?!\S)")  # after a letter or digit


def _plain(text: str) -> str:
    """A text with the same ids and fewer different words: lower case, trailing marks apart.  Itself if ids may differ."""
    if "<|" in text:
        return text
    low = text.lower()
    if not text.isascii() and ("\u03a3" in text or not is_normalized("NFC", text) or not is_normalized("NFC", low)):
        return text
    return _TRAILING.sub(r" \g<0>", low)


_ODD_SPACE = "\x1c\x1d\x1e\x1f"  # str.split() takes these for white space, the tokenizer does not


def text_ids(texts: list[str], words: _WordIds) -> list[bytes]:
    split = [None if any(c in t for c in _ODD_SPACE) else _plain(t).split() for t in texts]
    words.learn(set().union(*filter(None, split)))
    return [np.array(words.tokenizer.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() if ws is None
            else b"".join(map(words.__getitem__, ws)) for t, ws in zip(texts, split)]


def _blocks(texts: list[str], most_chars: int = 1 << 20):
    """(first, after last) of consecutive texts of about ``most_chars`` characters, one at least."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most_chars:
            yield start, i
            start, size = i, 0
        size += len(t)
    if len(texts):
        yield start, len(texts)


def pieces_of(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """One row per piece, with its number among the pieces of its length in its task."""
    def cut(batches):  # Arrow, not pandas, whose import alone takes as much of a worker as 150,000 words
        words = _worker_words(tokenizer_path)
        end = np.array([end_id], dtype="<u4").tobytes()
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            rows, doc_ids = [], batch.column("doc_id").to_pylist()
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in _blocks(texts):
                for doc_id, ids in zip(doc_ids[a:b], text_ids(texts[a:b], words)):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at:at + 4 * capacity]
                        n = len(part) // 4
                        rows.append((doc_id, k, at // 4, n, zlib.crc32(part), task, int(seen[n])))
                        seen[n] += 1
            yield _record_batch(PIECES, zip(*rows) if rows else [[]] * 7)

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(cut, PIECES)


def _record_batch(schema: str, columns) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32()}
    named = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, kinds[kind])
                                       for c, (_, kind) in zip(columns, named)], [name for name, _ in named])


class _Plan:
    """Runs of placed pieces and open space, by exact residual."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.left = capacity, dict(counts)
        self.rank = dict.fromkeys(counts, 0)
        self.runs: list[tuple[int, int, int, int, int, int]] = []  # length, r0, count, s0, offset, per sequence
        self.sequences = 0
        self.open: dict[int, list[tuple[int, int]]] = {}  # residual: (first sequence, sequences)
        self.sizes: list[int] = []  # sorted residuals with open sequences

    def place(self, length: int, s0: int, n: int, offset: int, per: int = 1) -> None:
        """``per`` pieces of ``length`` into each of ``n`` sequences from ``s0``."""
        self.runs.append((length, self.rank[length], n * per, s0, offset, per))
        self.rank[length] += n * per
        self.left[length] -= n * per

    def free(self, residual: int, s0: int, n: int) -> None:
        if residual and n:
            if residual not in self.open:
                self.open[residual] = []
                insort(self.sizes, residual)
            self.open[residual].append((s0, n))

    def take(self, residual: int, most: int) -> tuple[int, int]:
        s0, n = self.open[residual].pop()
        if n > most:
            self.open[residual].append((s0 + most, n - most))
            n = most
        if not self.open[residual]:
            del self.open[residual]
            self.sizes.pop(bisect_left(self.sizes, residual))
        return s0, n

    def fresh(self, n: int) -> int:
        s0, self.sequences = self.sequences, self.sequences + n
        return s0

    def best_fit(self, length: int) -> None:
        while self.left[length]:
            at = bisect_left(self.sizes, length)
            if at == len(self.sizes):
                per = min(self.capacity // length, self.left[length])
                n = self.left[length] // per
                s0 = self.fresh(n)
                self.place(length, s0, n, 0, per)
                self.free(self.capacity - per * length, s0, n)
                continue
            residual = self.sizes[at]
            s0, n = self.take(residual, self.left[length])
            self.place(length, s0, n, self.capacity - residual)
            self.free(residual - length, s0, n)


def _grouped(lengths: list[tuple[int, int]], groups: int) -> list[list[tuple[int, int]]]:
    """Lengths (descending, with counts) in at most ``groups`` groups of equal cardinality."""
    total = sum(n for _, n in lengths)
    share = max(1, -(-total // groups))
    out, now, room = [], [], share
    for length, n in lengths:
        while n:
            k = min(n, room)
            now.append((length, k))
            n, room = n - k, room - k
            if not room:
                out.append(now)
                now, room = [], share
    return out + [now] if now else out


def _fullest(sizes: list[int], supply: list[int], capacity: int) -> list[int]:
    """Group numbers of a configuration that holds the largest group left and fills best."""
    first = next(g for g, n in enumerate(supply) if n)
    room = capacity - sizes[first]
    reach: dict[int, tuple[int, ...]] = {0: ()}
    for g, size in enumerate(sizes):
        for _ in range(min(supply[g] - (g == first), room // size)):
            more = {s + size: (*c, g) for s, c in reach.items() if s + size <= room and s + size not in reach}
            if not more:
                break
            reach |= more
    return [first, *reach[max(reach)]]


def plan_packing(counts: dict[int, int], capacity: int = 2048, groups: int = 48, small: int = 0) -> _Plan:
    """Runs that place every piece of the histogram ``counts``; lengths up to ``small`` go best-fit."""
    small = small or capacity // 8
    plan = _Plan({k: n for k, n in counts.items() if n}, capacity)
    if plan.left.get(capacity):
        plan.place(capacity, plan.fresh(plan.left[capacity]), plan.left[capacity], 0)
    large = [(k, plan.left[k]) for k in sorted(plan.left, reverse=True) if small < k < capacity]
    members = _grouped(large, groups)
    sizes = [m[0][0] for m in members]
    supply = [sum(n for _, n in m) for m in members]
    while any(supply):
        config = _fullest(sizes, supply, capacity)
        times = min(supply[g] // config.count(g) for g in set(config))
        for g in config:
            supply[g] -= times
        while times:  # actual lengths in place of the rounded ones, run by run
            n = min(times, *(members[g][0][1] // config.count(g) or 1 for g in set(config)))
            s0, offset = plan.fresh(n), 0
            for g in config:
                length, have = members[g][0]
                if have < n:
                    raise AssertionError("a run is shorter than its share")
                plan.place(length, s0, n, offset)
                offset += length
                members[g][0] = (length, have - n)
                if have == n:
                    members[g].pop(0)
            plan.free(capacity - offset, s0, n)
            times -= n
    for length in sorted((k for k, n in plan.left.items() if n), reverse=True):
        plan.best_fit(length)
    return plan


def best_plan(counts: dict[int, int], capacity: int = 2048) -> _Plan:
    """The plan with the fewest sequences of a few settings: what counts as large, and the number of groups."""
    return min((plan_packing(counts, capacity, groups, capacity // part)
                for part in (4, 3, 2) for groups in (200, 400)), key=lambda p: p.sequences)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    with small_batches(spark):
        pieces = materialize(pieces_of(docs, tokenizer_path, capacity, end_id), "pack-pieces")
    per_task = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(per_task.withColumn("rank0", F.coalesce(F.sum("n").over(before), F.lit(0))), "pack-starts")
    counts = {r.length: r.n for r in starts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = np.array(sorted(best_plan(counts, capacity).runs), dtype=np.int64).reshape(-1, 6)
    shared = spark.sparkContext.broadcast(runs)  # its size depends on the capacity, not on the documents

    def settle(batches):
        length, r0, _, s0, offset, per = shared.value.T
        key = (length << 44) + r0
        for batch in batches:
            size, rank0, nth = (batch.column(c).to_numpy() for c in ("length", "rank0", "nth"))
            rank = rank0 + nth
            at = np.searchsorted(key, (size << 44) + rank, side="right") - 1
            k = rank - r0[at]
            doc_id, piece, start, crc = (batch.column(c) for c in ("doc_id", "piece", "start", "ids_crc32"))
            yield _record_batch(PLACED, (doc_id, piece, start, size, crc, s0[at] + k // per[at],
                                         offset[at] + k % per[at] * size))

    return (pieces.join(starts.drop("n"), ["task", "length"])
            .select("doc_id", "piece", "start", F.col("length").cast("long"), "ids_crc32", "rank0", "nth")
            .mapInArrow(settle, PLACED))
