"""Secret scan: three fixed patterns plus password guess-cost dynamic programming.

Values that follow a credential word are segmented at minimum guess cost
into dictionary words, dates, repeats, keyboard walks and brute-force
spans; a value whose cheapest segmentation needs at least
``min_log10_guesses`` guesses is a secret of kind ``guess``.  The word
list ranks all words of the corpus (counted over all documents) below the
usual password words; it stays a table, and each distinct value gets the
ranks of the words that stand in it by a join.

Defined results: null text is empty and has no spans; spans are code
points, end exclusive; repeated rows each get their own result; an added
span that overlaps a base span is left out.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renown.llm.common import sized, weighed
from renown.session import materialize

# The base patterns.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")  # maximal runs, as [0-9a-f]+ gives them
KINDS = ("assign", "access", "hex")

# Words that announce a credential.
_CONTEXT = re.compile(
    r"""(?<![A-Za-z])(?:pass(?:word|wd|phrase|code|wort)?|pwd|pin|mot\ de\ passe|contrase\xf1a|secret|token|api[_-]?key"""
    r"""|access[_-]?key|private[_-]?key|client[_-]?secret|auth|credentials?|login|bearer)["']?"""
    r"""(?:\x20{0,3}(?:[:=]|=>|->)\x20{0,3}|\x20(?:is|ist|est|es|bearer)\x20)["'\u201c\u201e\u2018\u00ab]?(\S{6,})""", re.IGNORECASE)
# The usual password words, most common first.
COMMON = ("password", "admin", "welcome", "login", "letmein", "qwerty", "dragon", "monkey", "master", "secret",
          "sunshine", "princess", "football", "shadow", "superman", "iloveyou", "trustno", "hello", "freedom",
          "whatever", "test", "guest", "root", "user", "change", "default", "summer", "winter", "spring", "autumn")
# What may close a value without being part of it.
_CLOSING = ".,;:!?)]}\"'\u201c\u201d\u2019\u00bb\u2026"
# Keyboard rows, without and with shift; all but the first start one key further right.
ROWS = (("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./"),
        ("~!@#$%^&*()_+", "QWERTYUIOP{}|", 'ASDFGHJKL:"', "ZXCVBNM<>?"))
_KEYS = {c: x + (y > 0) + 1000 * y for rows in ROWS for y, r in enumerate(rows) for x, c in enumerate(r)}
# Steps to the next key: in the row, to the row below (slightly right) and to the row above.
_STEPS = (1, -1, 1000, -1000, 999, -999)
_DATE = re.compile(r"(?:(?:19|20)\d\d(?:([-/._]?)\d{1,2}\1\d{1,2})?|\d{1,2}([-/._]?)\d{1,2}\2(?:19|20)?\d\d)")
_LEET = str.maketrans("4@310!$57+", "aaeioisstt")
_LONGEST_WORD, _LONGEST_DATE = 24, 10
_USUAL = {w: i + 1 for i, w in enumerate(COMMON)}


def _char_cost(v: str) -> float:
    kinds = [(str.islower, 26), (str.isupper, 26), (str.isdigit, 10), (lambda c: not c.isalnum(), 33)]
    plain = [c for c in v if c < "\x80"]
    size = sum(n for f, n in kinds if any(map(f, plain))) + 100 * (len(plain) < len(v))
    return math.log10(max(size, 10))


def _case_cost(word: str) -> float:
    upper = sum(map(str.isupper, word))
    if not upper or word[:1].isupper() and upper == 1 or upper == len(word):
        return math.log10(2) * bool(upper)
    return math.log10(math.comb(len(word), upper) * 2)


def _low(value: str) -> str:
    """Lower case, character by character: places stay."""
    return "".join(x if len(x := c.lower()) == 1 else c for c in value)


def _stretches(same: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(start, end) of the runs of at least ``least`` true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], same, [False])).astype(np.int8)))
    return [(a, b) for a, b in edges.reshape(-1, 2).tolist() if b - a >= least]


def repeats(value: str) -> list[tuple[int, int, int]]:
    """(unit, start, end): maximal runs of characters that repeat those ``unit`` places before, of a unit or more.

    Units go up to half the value; those that themselves repeat a shorter one are left out.
    """
    c, out = np.array([*map(ord, value)]), []
    for u in range(1, len(c) // 2 + 1):
        same = c[u:] == c[:-u]
        if np.count_nonzero(same) >= u:
            for a, b in _stretches(same, u):
                if not any(u % v == 0 and s - v <= a and b + u <= e for v, s, e in out):
                    out.append((u, a + u, b + u))
    return out


def shifted_walks(keys: np.ndarray) -> list[tuple[int, int, int]]:
    """(unit, start, end): maximal runs of keys that all lie one key beside those ``unit`` places before, the same way."""
    out = []
    for u in range(3, min(len(keys) // 2, len(ROWS[0][0])) + 1):  # a straight walk has no more keys than a row
        step = keys[u:] - keys[:-u]
        out += [(u, a + u, b + u) for d in _STEPS for a, b in _stretches(step == d, u)]
    return out


def guess_cost(value: str, ranks: dict[str, int]) -> float:
    """log10 of the guesses of the cheapest segmentation.

    Words and dates have bounded length; repeats and keyboard walks are
    maximal runs found once, and any part of a run costs as one segment.
    """
    n, per, low = len(value), _char_cost(value), _low(value)
    plain = low.translate(_LEET)
    keys = np.array([_KEYS.get(c, -10_000 * (i + 1)) for i, c in enumerate(value)])
    steps = np.diff(keys).tolist()  # those at characters without a key are no steps
    walk, turns, straight, same = [1] * n, [0] * n, [1] * n, [1] * n  # of the run that ends here
    for i in range(1, n):
        if steps[i - 1] in _STEPS:
            on = i > 1 and steps[i - 1] == steps[i - 2]
            walk[i], turns[i] = walk[i - 1] + 1, turns[i - 1] + (not on)
            straight[i] = straight[i - 1] + 1 if on else 2
        same[i] = same[i - 1] + 1 if value[i] == value[i - 1] else 1
    spans = [(a, b, a + u, 0.0) for u, a, b in repeats(value) if u > 1]
    spans += [(a, b, a + u, math.log10(len(_STEPS))) for u, a, b in shifted_walks(keys)]
    by_end = {}  # the unit of a span stands before and is paid for
    for a, b, full, extra in spans:
        for j in range(full, b + 1):
            by_end.setdefault(j, []).append((a, extra))
    step = math.log10(2)  # for each further segment
    best = [0.0] + [math.inf] * n
    for j in range(1, n + 1):
        cost = best[j - 1] + per
        if walk[j - 1] >= 3:
            k, t = walk[j - 1], turns[j - 1]
            ways = (math.lgamma(k) - math.lgamma(t) - math.lgamma(k - t + 1)) / math.log(10)  # places of the turns
            cost = min(cost, best[j - k] + step + math.log10(47 * k) + t * math.log10(len(_STEPS)) + ways)
        if straight[j - 1] >= 3:
            k = straight[j - 1]
            cost = min(cost, best[j - k] + step + math.log10(47 * len(_STEPS) * k))
        if same[j - 1] >= 3:
            k = same[j - 1]
            cost = min(cost, best[j - k] + step + per + math.log10(k))
        for a, extra in by_end.get(j, ()):
            cost = min(cost, best[a] + step + extra + math.log10(j - a))
        for k in range(4, min(j, _LONGEST_DATE) + 1):
            if value[j - k].isdigit() and _DATE.fullmatch(value, j - k, j):
                cost = min(cost, best[j - k] + step + math.log10(365 * 120 if k > 4 else 120) + 0.3)
        for k in range(3, min(j, _LONGEST_WORD) + 1):
            word = low[j - k:j]
            rank = ranks.get(word)
            leet = 0.0
            if rank is None and plain[j - k:j] != word:
                rank, leet = ranks.get(plain[j - k:j]), math.log10(4)
            if rank is not None:
                cost = min(cost, best[j - k] + step + math.log10(rank + 1) + leet + _case_cost(value[j - k:j]))
        best[j] = cost
    return best[n]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) by start, then kind."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, base) -> list[tuple[int, int]]:
    """(start, end) of the values after credential words that no base span overlaps."""
    out = []
    for m in _CONTEXT.finditer(text):
        value = m[1].rstrip(_CLOSING)
        start, end = m.start(1), m.start(1) + len(value)
        if len(value) >= 6 and not any(s < end and start < e for s, _, e in base):
            out.append((start, end))
    return out


def words_in(value: str) -> set[str]:
    """Every run of letters in ``value`` that ``guess_cost`` may look up, as it stands and read as leet."""
    low = _low(value)
    return {x[i:i + k] for text in {low, low.translate(_LEET)} for x in re.findall(r"[^\W\d_]{3,}", text)
            for i in range(len(x) - 2) for k in range(3, min(_LONGEST_WORD, len(x) - i) + 1)}


def value_words(text: str, spans) -> list[str]:
    """The words of the credential values of a text: assigned values, keys, hex runs and candidates.

    A span that begins or ends inside a word has only a part of it, which is left out.
    """
    out = []
    for start, end in spans:
        value = text[start:end]
        at = 0
        for word in re.findall(r"[^\W\d_]+", value):
            at = value.index(word, at)
            whole = not text[:start + at][-1:].isalpha() and not text[start + at + len(word):][:1].isalpha()
            if whole and 3 <= len(word) <= _LONGEST_WORD:
                out.append(word.lower())
            at += len(word)
    return out


def word_ranks(docs: DataFrame, own: DataFrame | None = None) -> DataFrame:
    """(w, rank) of all words of all documents by count, ties by the word, after the usual password words.

    ``own`` (w) are the occurrences inside credential values, which don't count: a
    secret of letters would else be a word of itself.
    The sort is by ranges; a rank is the place in its range and the sizes of the ranges before.
    """
    words = F.explode(F.split(F.lower(F.col("text")), r"\P{L}+")).alias("w")
    counts = docs.select(words).filter(F.length("w").between(3, _LONGEST_WORD)).groupBy("w").agg(F.count("*").alias("n"))
    if own is not None:
        counts = counts.join(own.groupBy("w").agg(F.count("*").alias("m")), "w", "left").select(
            "w", (F.col("n") - F.coalesce("m", F.lit(0))).alias("n")).filter("n > 0")
    placed = materialize(materialize(counts, "secret-words").orderBy(F.desc("n"), "w")
                         .select("w", F.monotonically_increasing_id().alias("at")), "secret-ranks")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    before, first = 1 + len(COMMON), []
    for r in sorted(placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()):  # one row a range
        first.append((r.part, before))
        before += r.n
    starts = placed.sparkSession.createDataFrame(first, "part long, before long")
    return placed.withColumn("part", part).join(F.broadcast(starts), "part").select("w", (F.col("before") + place).alias("rank"))


def strong_values(values: DataFrame, ranks: DataFrame, min_log10: float) -> DataFrame:
    """Written rows (value) of those ``values`` that need at least ``min_log10`` guesses."""
    def explode(batches):
        for pdf in batches:
            rows = [(i, w) for i, v in zip(pdf["id"], pdf["value"]) for w in sorted(words_in(v))]
            yield pd.DataFrame(rows, columns=["id", "w"])

    def weigh(batches):
        for pdf in batches:
            strong = [guess_cost(v, {**(dict(zip(w, r)) if w is not None else {}), **_USUAL}) >= min_log10
                      for v, w, r in zip(pdf["value"], pdf["words"], pdf["ranks"])]
            yield pdf.loc[strong, ["value"]]

    values = materialize(values.distinct().withColumn("id", F.monotonically_increasing_id()), "secret-values")
    held = materialize(values.mapInPandas(explode, "id long, w string"), "secret-parts")
    known = materialize(ranks.join(held.select("w").distinct(), "w"), "secret-known")
    by_value = held.join(sized(known), "w").groupBy("id").agg(F.collect_list(F.struct("w", "rank")).alias("x"))
    lists = by_value.select("id", F.col("x.w").alias("words"), F.col("x.rank").alias("ranks"))
    return materialize(values.join(lists, "id", "left").select("value", "words", "ranks")
                       .mapInPandas(weigh, "value string"), "secret-strong")


def scan_secrets(docs: DataFrame, ranks: DataFrame | None = None, min_log10_guesses: float = 8.0) -> DataFrame:
    """Per document: doc_id, spans array of (kind, start, end, base), ordered by start, then kind.

    ``ranks`` (w, rank) takes the place of the ranks of the documents' own words.
    """
    def scan(batches):
        for pdf in batches:
            spans, values, own = [], [], []
            for text in pdf["text"]:
                text = text or ""
                base = base_spans(text)
                more = candidates(text, base)
                spans.append([(KINDS[k], s, e, True) for s, k, e in base])
                values.append([(text[s:e], s, e) for s, e in more])
                assigned = [m.span(2) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
                own.append(value_words(text, [*assigned, *[(s, e) for s, k, e in base if k], *more]))
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "spans": spans, "found": values, "own": own})

    span = "struct<kind:string,start:long,end:long,base:boolean>"
    rows = materialize(docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInPandas(
        scan, f"doc_id long, spans array<{span}>, found array<struct<value:string,start:long,end:long>>, own array<string>")
        .withColumn("row", F.monotonically_increasing_id()), "secret-rows")
    found = rows.select("row", F.explode("found").alias("f")).select("row", "f.*")
    if ranks is None:
        ranks = word_ranks(docs, rows.select(F.explode("own").alias("w")))
    strong = strong_values(found.select("value"), ranks, min_log10_guesses)
    guess = F.struct(F.lit("guess").alias("kind"), "start", "end", F.lit(False).alias("base"))
    added = found.join(weighed(strong, F.octet_length("value")), "value").groupBy("row").agg(F.collect_list(guess).alias("added"))
    # A base span and an added one never start at the same place: they do not overlap.
    order = F.expr("array_sort(spans, (a, b) -> CASE WHEN a.start < b.start THEN -1 WHEN a.start > b.start THEN 1 "
                   f"ELSE cast(array_position(array('{"','".join(KINDS)}'), a.kind) - "
                   f"array_position(array('{"','".join(KINDS)}'), b.kind) AS int) END)")
    return (rows.select("doc_id", "row", "spans").join(added, "row", "left")
            .withColumn("spans", F.concat("spans", F.coalesce("added", F.array().cast(f"array<{span}>"))))
            .select("doc_id", order.alias("spans")))


def secret_report(docs: DataFrame) -> DataFrame:
    """The digest of ``scan_secrets`` that the query returns."""
    found = scan_secrets(docs)

    def told(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind):
        return F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda x: x["base"])
    return found.select(
        "doc_id", *map(count, KINDS),
        F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))
