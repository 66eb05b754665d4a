"""Brown class-based bigram language model.

P(w | previous) = P(class(w) | class(previous)) * P(w | class(w)).

Every training word is a type of its own.  Classes start from a small
clustering: the ``top_words`` most frequent words and ``endings`` hashed
endings of all others are exchanged one at a time on their bigram matrix.
Then ``sweeps`` exchange sweeps over all words follow.  The first moves all
words in one turn, the others take ``TURNS`` turns, each for the words of
every ``TURNS``-th hash range (all at once would overshoot there).  Counts of
(word, neighbour class) over the whole training corpus are summed by word,
and each word goes to the class that raises the likelihood of the class
bigrams most, all words of a turn against the class matrix that the turn
before left.  Only that matrix reaches the driver; a turn that does not
raise the likelihood is left out and ends the sweeps.  An unseen word has
the class that most training words of its ending (one of ``endings``
hashed ones) ended in.  Transitions are smoothed additively; emissions keep the share
(V+1)/(N+V+2) of a class (V words, N tokens) for its unseen words, times the
probability of the word's spelling: a chain of byte pairs counted over all
training tokens, whose probabilities of all words sum to 1.

Data flow: documents are cut into chunks of about ``chunk_tokens`` tokens,
each with its own sorted dictionary of word hashes, and written.  Chunk
dictionaries, not tokens, are shuffled by hash range; each range sums the
training counts and answers every chunk with counts for its slice.  The
answers meet the chunk's tokens again by chunk id.  No step needs the
vocabulary in one place, and a hot word is one entry per chunk.

Defined results: null and empty texts are the end token alone; a null
doc_id counts as the empty id text for the fold; repeated rows are
separate documents; without training tokens all words are unseen.
"""

from __future__ import annotations

import gc
import zlib

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renown.llm.common import id_text
from renown.session import discard, materialize

BINS = 64 * 64
TOP_WORDS, ENDINGS, CLASSES, CHUNK, SWEEPS, TURNS = 512, 512, 64, 1_000_000, 2, 2  # at most 256 classes
#: A hash range sums about so many dictionaries' worth of words at most, whatever the number of chunks.
CHUNKS_A_RANGE = 8
END = b"\n"  # cannot be a word
_PACKED = "chunk long, doc_ids binary, nulls binary, held binary, lens binary, tokens binary, hashes binary, " \
          "counts binary, endings binary, spelled binary, pairs binary"


def _pack(a: np.ndarray) -> bytes:
    return zlib.compress(a.tobytes(), 1)


def _unpack(b: bytes, dtype: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(b), dtype)


def words_of_text(text: str | None) -> list[bytes]:
    """Words in lower case (A-Z) between runs of ASCII white space, then the end token."""
    return [*(text or "").encode().lower().split(), END]


def ending_of(word: bytes, endings: int) -> int:
    return zlib.crc32(word[-3:]) % endings


def chunks_of(docs: DataFrame, folds: int = 7, fold: int = 2, endings: int = ENDINGS,
              chunk_tokens: int = CHUNK) -> DataFrame:
    """One written row per chunk: documents, tokens as places in the chunk's sorted dictionary, training counts."""
    def cut(batches):
        task, made = TaskContext.get().partitionId(), 0
        ids, held, lens, tokens, local, spelling = [], [], [], [], {}, [b""]

        def flush():
            nonlocal ids, held, lens, tokens, local, spelling, made
            n = np.array(lens, "<i4")
            h = np.fromiter((xxhash.xxh64_intdigest(w) for w in local), np.uint64, len(local))
            e = np.fromiter((ending_of(w, endings) for w in local), np.uint16, len(local))
            order = np.argsort(h, kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            t = place[np.array(tokens, np.int64)]
            train = np.repeat(~np.array(held), n)
            counts = np.bincount(t[train], minlength=len(order))
            words = list(local)
            spelled = [b"" if counts[k] or words[j] == END else words[j] for k, j in enumerate(order)]
            row = ((task << 32) + made, np.array([i or 0 for i in ids], "<i8").tobytes(),
                   np.array([i is None for i in ids]).tobytes(), np.array(held).tobytes(), n.tobytes(),
                   _pack(t.astype("<u4")), h[order].tobytes(), _pack(counts.astype("<u4")), _pack(e[order]),
                   zlib.compress(b"\n".join(spelled), 1), _pack(_byte_pairs(b" ".join([*spelling, b""]))))
            ids, held, lens, tokens, local, spelling, made = [], [], [], [], {}, [b""], made + 1
            return pd.DataFrame([row], columns=[c.split()[0] for c in _PACKED.split(", ")])

        for pdf in batches:
            for doc_id, out, text in zip(pdf["doc_id"].astype("Int64"), pdf["held_out"], pdf["text"]):
                words, add = words_of_text(text), local.setdefault
                tokens += [add(w, len(local)) for w in words]
                ids.append(None if doc_id is pd.NA else int(doc_id))
                held.append(bool(out))
                if not out:
                    spelling += words[:-1]
                lens.append(len(words))
                if len(tokens) >= chunk_tokens:
                    yield flush()
        if lens:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long"), (F.crc32(id_text(F.col("doc_id"))) % folds == fold)
                       .alias("held_out"), "text")
    return materialize(rows.mapInPandas(cut, _PACKED), "lm-chunks")


def _byte_pairs(text: bytes) -> np.ndarray:
    """Counts of neighbouring bytes, 256 * first + second; a blank stands for the start and the end of a word."""
    b = np.frombuffer(text, np.uint8)
    return np.bincount(b[:-1].astype(np.uint16) * 256 + b[1:], minlength=1 << 16)


def byte_chain(pairs: np.ndarray) -> np.ndarray:
    """log10 P(byte | byte before) from counts of ``pairs``; -inf where no lower-case word has the pair."""
    b = np.arange(256)
    inside = ~np.isin(b, list(b" \t\n\r\x0b\x0c")) & ~((b >= 65) & (b <= 90))
    p = np.where(inside, pairs.reshape(256, 256) + 1.0, 0)
    p[inside, 32] = pairs.reshape(256, 256)[inside, 32] + 1.0  # a word ends, but not before its first byte
    with np.errstate(divide="ignore"):
        return np.log10(p / p.sum(axis=1, keepdims=True))


def spelling_scores(words: list[bytes], chain: np.ndarray) -> np.ndarray:
    """log10 probability of each word's spelling."""
    if not words:
        return np.zeros(0)
    b = np.frombuffer(b" ".join([b"", *words, b""]), np.uint8)
    return np.add.reduceat(chain[b[:-1], b[1:]], np.flatnonzero(b == 32)[:-1])


def _bins(counts: np.ndarray) -> np.ndarray:
    """Logarithmic bins, 64 for each doubling."""
    return np.floor(np.log2(counts) * 64).astype(np.int64)


def _added(rows: DataFrame, column: str) -> np.ndarray:
    """Sum of packed arrays: one row per task, then 32 groups."""
    def total(packed):
        return _pack(sum((_unpack(b, "<i8") for b in packed), np.zeros(1, np.int64)))

    def of_task(batches):
        packed = [total(pdf[column]) for pdf in batches if len(pdf)]
        yield pd.DataFrame({"g": [TaskContext.get().partitionId() % 32] if packed else [], "a": [total(packed)] if packed else []})

    def of_group(pdf):
        return pd.DataFrame({"a": [total(pdf["a"])]})

    sums = rows.select(column).mapInPandas(of_task, "g int, a binary").groupBy("g").applyInPandas(of_group, "a binary")
    return sum((_unpack(r.a, "<i8") for r in sums.collect()), np.zeros(1, np.int64))


def count_words(chunks: DataFrame, ranges: int, top_words: int, endings: int) -> DataFrame:
    """Written rows: an answer for each chunk and hash range, and one row of totals for each range.

    Answers hold the counts of the chunk's words and their places (as steps) among all words of the range.
    """
    bits = max(1, (ranges - 1).bit_length())

    def deal(batches):
        edges = (np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
        for pdf in batches:
            for chunk, h, c, e in zip(pdf["chunk"], pdf["hashes"], pdf["counts"], pdf["endings"]):
                h, c, e = np.frombuffer(h, np.uint64), _unpack(c, "<u4"), _unpack(e, "<u2")
                at = [0, *np.searchsorted(h, edges).tolist(), len(h)]
                rows = [(r, chunk, h[a:b].tobytes(), _pack(c[a:b]), _pack(e[a:b]))
                        for r, (a, b) in enumerate(zip(at, at[1:])) if b > a]
                yield pd.DataFrame(rows, columns=["range", "chunk", "hashes", "counts", "endings"])

    def merge(pdf):
        h = [np.frombuffer(x, np.uint64) for x in pdf["hashes"]]
        words, first, inverse = np.unique(np.concatenate(h), return_index=True, return_inverse=True)
        counts = np.bincount(inverse, np.concatenate([_unpack(x, "<u4") for x in pdf["counts"]])).astype(np.int64)
        kind = np.concatenate([_unpack(x, "<u2") for x in pdf["endings"]])[first]
        at = np.cumsum([0, *map(len, h)])
        answers = [_pack(counts[inverse[a:b]].astype("<u8")) for a, b in zip(at, at[1:])]
        places = [_pack(np.diff(inverse[a:b], prepend=0).astype("<u4")) for a, b in zip(at, at[1:])]
        out = pd.DataFrame({"chunk": pdf["chunk"], "range": pdf["range"], "answer": answers, "places": places})
        seen = np.nonzero(counts)[0]
        most = seen[np.lexsort((words[seen], -counts[seen]))][:top_words]
        totals = pd.DataFrame({
            "range": [int(pdf["range"].iloc[0])],
            "totals": [_pack(np.concatenate([np.bincount(kind[seen], minlength=endings),
                                             np.bincount(_bins(counts[seen]), minlength=BINS)]).astype("<i8"))],
            "top": [[(int(a), int(b), int(c)) for a, b, c in zip(words[most].view(np.int64), counts[most], kind[most])]]})
        return pd.concat([out, totals], ignore_index=True).astype({"chunk": "Int64"}).replace({np.nan: None})

    dealt = chunks.select("chunk", "hashes", "counts", "endings").mapInPandas(
        deal, "range int, chunk long, hashes binary, counts binary, endings binary")
    return materialize(dealt.groupBy("range").applyInPandas(
        merge, "chunk long, range int, answer binary, places binary, totals binary, "
               "top array<struct<hash:long,count:long,ending:int>>"), "lm-counts")


def type_bigrams(chunks: DataFrame, top: np.ndarray, top_types: np.ndarray, types: int, shift: int) -> np.ndarray:
    """types x types counts of neighbours in training documents; a document follows an end token."""
    def count(batches):
        total = np.zeros(types * types, np.int64)
        for pdf in batches:
            for held, lens, tokens, h, e in zip(pdf["held"], pdf["lens"], pdf["tokens"], pdf["hashes"], pdf["endings"]):
                t = _types(np.frombuffer(h, np.uint64), _unpack(e, "<u2"), top, top_types, shift)[_unpack(tokens, "<u4")]
                t = t[np.repeat(~np.frombuffer(held, bool), np.frombuffer(lens, "<i4"))]
                if len(t):
                    total += np.bincount(np.concatenate(([0], t[:-1])) * types + t, minlength=types * types)
        total = total.reshape(types, types)
        rows = np.nonzero(total.any(axis=1))[0]
        yield pd.DataFrame({"row": rows, "counts": [_pack(total[r]) for r in rows]})

    def add(pdf):
        total = sum(_unpack(b, "<i8") for b in pdf["counts"])
        return pd.DataFrame({"row": pdf["row"].iloc[:1], "counts": [_pack(total)]})

    rows = chunks.select("held", "lens", "tokens", "hashes", "endings").mapInPandas(count, "row int, counts binary")
    out = np.zeros((types, types), np.int64)
    for r in rows.groupBy("row").applyInPandas(add, "row int, counts binary").collect():  # at most ``types`` rows
        out[r.row] = _unpack(r.counts, "<i8")
    return out


def _types(hashes: np.ndarray, endings: np.ndarray, top: np.ndarray, top_types: np.ndarray, shift: int) -> np.ndarray:
    """Type of each dictionary entry: its own if it is a top word, else that of its ending."""
    out = endings.astype(np.int64) + shift
    at = np.searchsorted(top, hashes)
    at[at == len(top)] = 0
    own = top[at] == hashes
    out[own] = top_types[at[own]]
    return out


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(bigrams: np.ndarray, classes: int = CLASSES, sweeps: int = 8) -> np.ndarray:
    """Class of every type; type 0, the end token, keeps class 0 to itself."""
    n = len(bigrams)
    b = bigrams.astype(np.float64)
    order = np.argsort(-(b.sum(axis=0) + b.sum(axis=1)), kind="stable")
    order = order[order != 0]
    cls = np.zeros(n, np.int64)
    cls[order] = 1 + np.arange(len(order)) % max(1, classes - 1)
    member = np.zeros((n, classes))
    member[np.arange(n), cls] = 1
    out_of, into = b @ member, (b.T @ member)  # type x class
    g = member.T @ out_of
    for _ in range(sweeps):
        moved = 0
        for w in order:
            a, own = cls[w], b[w, w]
            r, left = out_of[w].copy(), into[w].copy()
            r[a] -= own
            left[a] -= own
            g[a] -= r
            g[:, a] -= left
            g[a, a] -= own
            rows, cols = g.sum(axis=1), g.sum(axis=0)
            gain = ((_xlogx(g + r) - _xlogx(g)).sum(axis=1) + (_xlogx(g + left[:, None]) - _xlogx(g)).sum(axis=0))
            d = np.diag(g)
            gain += _xlogx(d + r + left + own) + _xlogx(d) - _xlogx(d + r) - _xlogx(d + left)
            gain -= _xlogx(rows + r.sum() + own) - _xlogx(rows) + _xlogx(cols + left.sum() + own) - _xlogx(cols)
            gain[0] = -np.inf
            best = int(np.argmax(gain))
            if gain[best] <= gain[a] + 1e-9:
                best = a
            g[best] += r
            g[:, best] += left
            g[best, best] += own
            if best != a:
                cls[w], moved = best, moved + 1
                out_of[:, a] -= b[:, w]
                out_of[:, best] += b[:, w]
                into[:, a] -= b[w]
                into[:, best] += b[w]
        if not moved:
            break
    return cls


def likelihood(g: np.ndarray) -> float:
    """Log likelihood of the class bigrams ``g``, but for what does not depend on the classes."""
    return _xlogx(g).sum() - _xlogx(g.sum(axis=0)).sum() - _xlogx(g.sum(axis=1)).sum()


def best_classes(keys: np.ndarray, n: np.ndarray, cls: np.ndarray, g: np.ndarray, batch: int = 1 << 14) -> np.ndarray:
    """Class of each word after it alone moves to its best one; words of class 0 and words without counts stay.

    ``keys`` (sorted) are word * (2 * classes + 1) + column: columns count the
    classes before the word, those after it, and the word after itself.
    """
    k = len(g)
    width, out = 2 * k + 1, cls.astype(np.int64)
    rows, cols = g.sum(axis=1), g.sum(axis=0)
    word = keys // width
    starts = np.flatnonzero(np.diff(word, prepend=-1))
    cuts = np.unique(np.searchsorted(starts, np.arange(0, len(keys) + batch, batch)))
    for a, b in zip(cuts, cuts[1:]):
        lo, hi = starts[a], starts[b] if b < len(starts) else len(keys)
        ids = word[starts[a:b]]
        x = np.zeros((b - a, width))
        x[np.searchsorted(ids, word[lo:hi]), keys[lo:hi] % width] = n[lo:hi]
        left, right, own = x[:, :k], x[:, k:-1], x[:, -1]
        at, of = np.arange(b - a), out[ids]
        left[at, of] -= own
        right[at, of] -= own
        gain = np.zeros((b - a, k))
        for mine, other, m in ((right, left, g), (left, right, g.T)):
            i, c = np.nonzero(mine)
            if not len(i):
                continue
            v = m.T[c].copy()  # cells (class, c) without the word
            e = np.arange(len(i))
            v[e, of[i]] -= mine[i, c]
            same = np.flatnonzero(of[i] == c)
            v[same] -= other[i[same]]
            v[same, c[same]] -= own[i[same]]
            first = np.flatnonzero(np.diff(i, prepend=-1))
            gain[i[first]] += np.add.reduceat(_xlogx(v + mine[i, c][:, None]) - _xlogx(v), first, axis=0)
        d = np.tile(np.diag(g), (b - a, 1))
        d[at, of] -= left[at, of] + right[at, of] + own
        o = own[:, None]
        gain += _xlogx(d + right + left + o) + _xlogx(d) - _xlogx(d + right) - _xlogx(d + left)
        for side, total in ((right, rows), (left, cols)):
            mass = side.sum(axis=1) + own
            base = np.tile(total, (b - a, 1))
            base[at, of] -= mass
            gain -= _xlogx(base + mass[:, None]) - _xlogx(base)
        gain[:, 0] = -np.inf
        best = gain.argmax(axis=1)
        moved = (gain[at, best] > gain[at, of] + 1e-9) & (of != 0)
        out[ids[moved]] = best[moved]
    return out


def neighbours(chunks: DataFrame, answers: DataFrame, model: ClassModel, turn: tuple[int, int] | None) -> DataFrame:
    """One row of class bigrams a chunk and, with a ``turn``, (word, neighbour class) counts by chunk and hash range.

    A turn (of, at) moves the words of ranges that leave ``at`` when divided by ``of``.  Ranges that do not move in this turn have zero counts for their training words, and nothing else.
    """
    shared = chunks.sparkSession.sparkContext.broadcast(vars(model))
    k, started = len(model.trans), "cls" in answers.columns
    width = 2 * k + 1

    def count(left, right):
        m = ClassModel.__new__(ClassModel)
        vars(m).update(shared.value)
        right, out = right.sort_values("range"), []
        for row in left.itertuples(index=False):
            endings = _unpack(row.endings, "<u2")
            if started:
                cls = np.concatenate([_unpack(c, "u1") for c in right["cls"]])
            else:
                cls = m.first_classes(np.frombuffer(row.hashes, np.uint64), endings).astype("u1")
            t = _unpack(row.tokens, "<u4").astype(np.int64)
            t = t[np.repeat(~np.frombuffer(row.held, bool), np.frombuffer(row.lens, "<i4"))]
            now = cls[t].astype(np.int64)
            before = np.concatenate(([0], now[:-1]))[:len(now)]
            out.append((None, row.chunk, None, None, None, None, None, _pack(np.bincount(before * k + now, minlength=k * k))))
            if turn is None:
                continue
            sizes = [len(_unpack(p, "<u4")) for p in right["places"]]
            ends = np.cumsum(sizes)
            moves = np.repeat(right["range"].to_numpy(np.int64) % turn[0] == turn[1], sizes)[t]
            ahead = moves[:-1]
            keys, n = _summed(np.concatenate([(t * width + before)[moves], (t[:-1] * width + k + now[1:])[ahead],
                                              t[:-1][ahead & (t[1:] == t[:-1])] * width + 2 * k]))
            still = np.unique(t[~moves]) * width
            keys, n = np.concatenate([keys, still]), np.concatenate([n, np.zeros(len(still), n.dtype)])
            order = np.argsort(keys, kind="stable")
            keys, n = keys[order], n[order]
            at = np.searchsorted(keys, ends * width)
            for r, places, a, b, i, j in zip(right["range"], right["places"], [0, *ends], ends, [0, *at], at):
                out.append((r, row.chunk, places, _pack(cls[a:b]), _pack(endings[a:b]),
                            _pack(np.diff(keys[i:j] - a * width, prepend=0).astype("<u4")), _pack(n[i:j].astype("<u4")), None))
        return pd.DataFrame(out, columns=["range", "chunk", "places", "cls", "endings", "keys", "n", "g"]).astype({"range": "Int64"})

    columns = ["chunk", "held", "lens", "tokens", "endings", *([] if started else ["hashes"])]
    return chunks.select(*columns).groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(
        count, "range int, chunk long, places binary, cls binary, endings binary, keys binary, n binary, g binary")


def _summed(keys: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of ``n`` (or the count) of each."""
    if n is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.diff(first, append=len(keys)) if n is None else np.add.reduceat(n, first) if len(n) else n


def moved_words(dealt: DataFrame, g: np.ndarray, endings: int, turn: tuple[int, int], reduce_at: int = 1 << 22) -> DataFrame:
    """Written rows: the new classes of each chunk's words by hash range, and its words of each ending and class."""
    k = len(g)
    width, shared = 2 * k + 1, dealt.sparkSession.sparkContext.broadcast(g)

    def move(pdf):
        g = shared.value.astype(np.float64)
        places = [np.cumsum(_unpack(p, "<u4").astype(np.int64)) for p in pdf["places"]]
        cls = np.zeros(1 + max(p[-1] for p in places), np.int64)
        kind = np.zeros(len(cls), np.int64)
        keys, n, waiting = [], [], 0
        for p, c, e, key, m in zip(places, pdf["cls"], pdf["endings"], pdf["keys"], pdf["n"]):
            cls[p], kind[p] = _unpack(c, "u1"), _unpack(e, "<u2")
            key = np.cumsum(_unpack(key, "<u4").astype(np.int64))
            keys.append(p[key // width] * width + key % width)
            n.append(_unpack(m, "<u4").astype(np.int64))
            waiting += len(key)
            if waiting >= reduce_at:
                key, m = _summed(np.concatenate(keys), np.concatenate(n))
                keys, n, waiting = [key], [m], 0
        keys, n = _summed(np.concatenate(keys), np.concatenate(n))
        number = int(pdf["range"].iloc[0])
        new = best_classes(keys, n, cls, g) if number % turn[0] == turn[1] else cls
        seen = np.unique(keys[keys % width < k] // width)
        out = pd.DataFrame({"chunk": pdf["chunk"], "range": pdf["range"], "places": pdf["places"],
                            "cls": [_pack(new[p].astype("u1")) for p in places]})
        totals = pd.DataFrame({"range": [number], "totals": [
            _pack(np.bincount(kind[seen] * k + new[seen], minlength=endings * k).astype("<i8"))]})
        return pd.concat([out, totals], ignore_index=True).astype({"chunk": "Int64"}).replace({np.nan: None})

    return materialize(dealt.groupBy("range").applyInPandas(
        move, "chunk long, range int, places binary, cls binary, totals binary"), "lm-classes")


def refine(chunks: DataFrame, counts: DataFrame, model: ClassModel, sweeps: int = SWEEPS) -> tuple[DataFrame | None, ClassModel]:
    """Sweeps over all words: their classes by chunk and hash range (None: as they start), and the model with them.

    The model's ``gains`` are the likelihoods of the start and after each turn.
    """
    spark, k = chunks.sparkSession, len(model.trans)
    answers, kept, best, words = counts.filter("answer IS NOT NULL").select("chunk", "range", "places"), None, None, None
    endings, gains = len(model.ending_cls), []
    turns = ([(1, 0)] + [(TURNS, i) for i in range(TURNS)] * (sweeps - 1)) if sweeps else []
    for turn, moving in enumerate([*turns, None]):
        seen = materialize(neighbours(chunks, answers, model, moving), "lm-neighbours")
        g = np.broadcast_to(_added(seen.filter("g IS NOT NULL"), "g"), k * k).reshape(k, k).astype(np.float64)
        better = best is None or likelihood(g) > likelihood(best)
        gains.append(likelihood(g))
        if better:
            best = g
            if turn:
                if kept is not None:
                    discard(kept)
                kept, model = answers, model.with_classes(g, words.reshape(endings, k))
            if moving is not None:
                moved = moved_words(seen.filter("range IS NOT NULL").drop("g"), g, endings, moving)
                words = np.broadcast_to(_added(moved.filter("totals IS NOT NULL"), "totals"), endings * k)
                answers = moved.filter("chunk IS NOT NULL").drop("totals")
        discard(seen)
        gc.collect()  # shuffle files of a turn go when neither side holds it any more
        spark.sparkContext._jvm.System.gc()
        if not better:
            break
    model.gains = gains
    return kept, model


class ClassModel:
    """Log10 probabilities by class; everything in it is bounded by the model's parameters."""

    def __init__(self, top, top_types, shift, cls, trans, tokens, words, n_tokens, n_words, chain):
        self.top, self.top_types, self.shift, self.cls = top, top_types, shift, cls
        self.n, self.v, self.chain = n_tokens, n_words, chain
        row = trans.sum(axis=1, keepdims=True)
        self.trans = np.log10((trans + 0.5) / (row + 0.5 * trans.shape[1]))
        unseen = (words + 1) / (tokens + words + 2)
        self.unseen = np.log10(unseen)
        self.seen = np.log10(1 - unseen) - np.log10(np.maximum(tokens, 1))
        self.ending_cls, self.gains = cls[shift:], []

    def with_classes(self, bigrams, words):
        """The model with other classes of the training words: their class bigrams and ``words`` of each ending and class."""
        out = ClassModel(self.top, self.top_types, self.shift, self.cls, bigrams, bigrams.sum(axis=0), words.sum(axis=0),
                         self.n, self.v, self.chain)
        known = words[:, 1:].any(axis=1)
        out.ending_cls = np.where(known, 1 + words[:, 1:].argmax(axis=1), self.ending_cls)
        return out

    def first_classes(self, hashes, endings):
        """Classes that dictionary entries start with."""
        return self.cls[_types(hashes, endings, self.top, self.top_types, self.shift)]

    def entry_scores(self, c, counts, spelled):
        """log10 P(word | class) and base log10 of each dictionary entry of class ``c``.

        ``spelled`` has the words that are not in training documents; the end token, alone in its class, is empty there.
        """
        known = counts > 0
        emit = np.where(known, self.seen[c] + np.log10(np.maximum(counts, 1)), self.unseen[c])
        new = [i for i in np.flatnonzero(~known).tolist() if spelled[i]]
        emit[new] += spelling_scores([spelled[i] for i in new], self.chain)
        return emit, np.log10((counts + 1) / (self.n + 1 * (self.v + 1)))


def train(chunks: DataFrame, counts: DataFrame, top_words: int = TOP_WORDS, endings: int = ENDINGS,
          classes: int = CLASSES) -> ClassModel:
    totals = counts.filter("totals IS NOT NULL")
    sums = np.broadcast_to(_added(totals, "totals"), endings + BINS)
    above = np.cumsum(sums[endings:][::-1])[::-1]  # words in a bin or a higher one
    least = int(2 ** (np.nonzero(above >= min(top_words, above[0]))[0][-1] / 64)) if above[0] else 1
    frequent = F.filter("top", lambda t: t["count"] >= least)  # hardly more than top_words in all
    top = (totals.select(F.explode(frequent).alias("t")).select("t.*")
           .orderBy(F.desc("count"), "hash").limit(top_words).collect())
    end = int(np.uint64(xxhash.xxh64_intdigest(END)).astype(np.int64))
    rest = [r for r in top if r.hash != end]
    shift = 1 + len(rest)
    types = shift + endings
    h = np.array([end, *[r.hash for r in rest]], np.int64).view(np.uint64)
    order = np.argsort(h)
    hashes, own = h[order], np.arange(len(h))[order]
    bigrams = type_bigrams(chunks, hashes, own, types, shift)
    cls = exchange(bigrams, classes)
    n, v = bigrams.sum(axis=0).astype(float), np.zeros(types)
    v[shift:] = sums[:endings]
    v[1:shift] = 1  # top words leave the type of their ending, and so does the end token
    v[0] = float(n[0] > 0)
    for ending in [ending_of(END, endings)] * int(v[0]) + [r.ending for r in rest]:
        v[shift + ending] -= 1
    member = np.zeros((types, classes))
    member[np.arange(types), cls] = 1
    return ClassModel(hashes, own, shift, cls, member.T @ bigrams @ member, member.T @ n, member.T @ v,
                      int(n.sum()), int(v.sum()), byte_chain(np.broadcast_to(_added(chunks, "pairs"), 1 << 16)))


def score_texts(docs: DataFrame, folds: int = 7, fold: int = 2, top_words: int = TOP_WORDS, endings: int = ENDINGS,
                classes: int = CLASSES, chunk_tokens: int = CHUNK, sweeps: int = SWEEPS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity of every row."""
    spark = docs.sparkSession
    chunks = chunks_of(docs, folds, fold, endings, chunk_tokens)
    ranges = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), chunks.count() // CHUNKS_A_RANGE)
    counts = count_words(chunks, ranges, top_words, endings)
    found, m = refine(chunks, counts, train(chunks, counts, top_words, endings, classes), sweeps)
    shared = spark.sparkContext.broadcast(vars(m))

    def score(left, right):
        model = ClassModel.__new__(ClassModel)
        vars(model).update(shared.value)
        out = []
        right = right.sort_values("range")
        answers, classes = right["answer"].dropna(), right["cls"].dropna()
        for row in left.itertuples(index=False):
            c = np.concatenate([_unpack(a, "<u8") for a in answers]).astype(np.float64)
            if len(classes):
                cls = np.concatenate([_unpack(x, "u1") for x in classes])
                kinds = _unpack(row.endings, "<u2")
                cls = np.where((c > 0) | (cls == 0), cls, model.ending_cls[kinds])  # class 0: the end token
            else:
                cls = model.first_classes(np.frombuffer(row.hashes, np.uint64), _unpack(row.endings, "<u2"))
            emit, base = model.entry_scores(cls, c, zlib.decompress(row.spelled).split(b"\n"))
            t, lens = _unpack(row.tokens, "<u4"), np.frombuffer(row.lens, "<i4")
            now = cls[t]
            p = model.trans[np.concatenate(([0], now[:-1])), now] + emit[t]  # the token before a document is an end
            starts = np.cumsum(lens) - lens
            ids = pd.array(np.frombuffer(row.doc_ids, "<i8"), dtype="Int64")
            ids[np.frombuffer(row.nulls, bool)] = pd.NA
            total = np.add.reduceat(p, starts)
            out.append(pd.DataFrame({
                "doc_id": ids, "held_out": np.frombuffer(row.held, bool), "n_tokens": lens.astype(np.int64),
                "n_known": np.add.reduceat((c > 0).astype(np.int64)[t], starts), "train_tokens": model.n,
                "base_score": np.add.reduceat(base[t], starts), "score": total, "perplexity": 10 ** (-total / lens)}))
        return pd.concat(out)

    answers = counts.filter("answer IS NOT NULL").select("chunk", "range", "answer", F.lit(None).cast("binary").alias("cls"))
    if found is not None:
        answers = answers.unionByName(found.select("chunk", "range", F.lit(None).cast("binary").alias("answer"), "cls"))
    return (chunks.drop("counts", "pairs").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
               "score double, perplexity double"))
