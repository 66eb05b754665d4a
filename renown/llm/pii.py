"""Personal data by weak supervision, in DataFrame functions alone.

Candidates are the matches of four base patterns (also those that fail
their check) and of looser patterns.  Labelers -- the pattern's own check,
a gazetteer, context words before the match, and the match's shape -- vote
for, against, or abstain.  Expectation-maximisation (two classes, votes
independent given the class) estimates each labeler's reliability per kind
from the counts of vote patterns; its posteriors are the soft labels from
which the final span classifier, naive Bayes over votes and shape
features, is trained.  The counts are small tables whose size depends on
the numbers of labelers and feature values only.  Base matches always
stay; the classifier adds spans that do not overlap one of the same kind.

Defined results: null text is empty and has no spans; positions are code
points, end exclusive; repeated rows each get their own result; without
candidates nothing is learnt and nothing added.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renown.functions.text import let
from renown.session import materialize

KINDS = ("email", "ip", "card", "phone")
# The base patterns.  Possessive repeats give the same matches without recursion or rescans.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:\(at\)|\[at\]|\{at\}| at ) ?[A-Za-z0-9-]++"
             r"(?:(?: ?(?:\(dot\)|\[dot\]|\{dot\}) ?| dot |\.)[A-Za-z0-9-]{2,63}+)++",
    "ip": r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
    "phone": r"(?<![0-9A-Za-z+.-])(?:00[1-9][0-9]{0,2}[ .-])?\(?0?[1-9][0-9]{1,3}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z.-])",
}
#: A text without this cannot match.
GATES = {"email": r"@|[(\[{ ]at[)\]} ]", "ip": r"[0-9A-Fa-f][.:][0-9A-Fa-f]", "card": r"[0-9][ -]?[0-9]",
         "phone": r"[0-9][ ().-]?[0-9]|\+[0-9]"}
# Card numbers inside a longer run of digit groups, in the usual groups; the shorter and the longer reading.
_CARD = r"(?<![0-9])(?:[0-9]{4}(?:[ -]?[0-9]{4}){3}%s|3[0-9]{3}[ -]?[0-9]{6}[ -]?[0-9]{4,5}|[0-9]{13,19})(?![0-9])"
CARDS = (_CARD % "", _CARD % "[ -]?[0-9]{1,3}")
# Gazetteers.
TLDS = ("com", "org", "net", "edu", "gov", "info", "io", "co", "de", "fr", "es", "uk", "it", "nl", "eu", "us", "ch",
        "at", "be", "pt", "ca", "au", "jp", "cn", "ru", "br", "mx", "in", "biz", "dev", "app", "me")
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35|30[0-5]|36|38)"
CALLING = r"^\+(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|21|22|23|24|25|26|29|35|37|38|42|50|59|67|68|69|80|85|87|88|96|97|99)"
CONTEXT = {
    "email": r"e-?mail|contact|write|reach|kontakt|correo|courriel|address",
    "ip": r"\bip\b|host|server|address|login|from|client|adresse",
    "card": r"card|visa|master|amex|credit|debit|payment|karte|carte|tarjeta",
    "phone": r"phone|call|tel\b|tel\.|mobile|cell|fax|contact|anruf|telefon|appel|llam",
}
LABELERS = ("check", "gazetteer", "context", "shape")
FEATURES = (*LABELERS, "digits", "marks", "edge")


#: Matches of a text are placed in chunks of so many: a fold copies what it has at every step.
CHUNK = 64
#: Characters before a match that the labelers see.  A match has two characters at least.
AROUND = 40


def matches(text: Column, pattern: str) -> Column:
    """Array of (s, e, m, b) of the leftmost non-overlapping matches, in code points; b is the text before one.

    Places within a chunk of matches come from one fold and the chunks' own
    places from another; the text before a match is put together from the
    pieces before it.  So the work hardly grows faster than the matches.
    """
    both = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                      lambda g, m: F.struct(g.alias("t"), m.alias("m")))
    sizes = F.transform(F.filter(both, lambda x: x["m"].isNotNull()), lambda x: F.struct(
        F.length(x["t"]).alias("g"), x["m"].alias("m"), F.right(x["t"], F.lit(AROUND)).alias("w")))

    def step(acc, x):
        s = acc["at"] + x["g"]
        e = s + F.length(x["m"])
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(F.struct(s.alias("s"), e.alias("e")))).alias("out"))

    def within(chunk):
        return F.aggregate(chunk, F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int>>").alias("out")), step)

    def onward(acc, chunk):
        return F.struct((acc["at"] + chunk["at"]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))

    def flat(chunks):
        first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        starts = F.aggregate(chunks, first, onward, lambda acc: acc["out"])
        return F.flatten(F.zip_with(chunks, starts, lambda c, at: F.transform(c["out"], lambda x: F.struct(
            (x["s"] + at).alias("s"), (x["e"] + at).alias("e")))))

    def placed(found):
        numbers = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(found) / CHUNK).cast("int") - 1, F.lit(0)))
        chunks = F.transform(numbers, lambda i: within(F.slice(found, i * CHUNK + 1, F.lit(CHUNK))))
        return F.zip_with(let(chunks, flat), F.transform(found, lambda x, i: F.struct(x.alias("x"), i.alias("i"))),
                          lambda at, y: F.struct(at["s"].alias("s"), at["e"].alias("e"), y["x"]["m"].alias("m"),
                                                 before(found, y["x"], y["i"]).alias("b")))

    def before(found, x, i):
        n = F.least(i, F.lit(AROUND // 2))
        pieces = F.transform(F.slice(found, i - n + 1, n), lambda y: F.concat(y["w"], F.right(y["m"], F.lit(AROUND))))
        return F.right(F.concat(F.array_join(pieces, ""), x["w"]), F.lit(AROUND))

    return let(sizes, placed)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    def add(acc, i):
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        return acc + F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def check(kind: str, m: Column) -> Column:
    """Whether a base match stands."""
    if kind == "ip":
        parts = F.split(F.regexp_replace(m, r"(^|\.)0+(?=[0-9])", "$1"), r"\.")
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (p.try_cast("int") <= 255))
    if kind == "card":
        n = F.length(_digits(m))
        return F.when(n.between(13, 19), luhn(_digits(m))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column | None = None) -> Column:
    out = F.when(yes, 1)
    return (out if no is None else out.when(no, -1)).otherwise(0)


def _labels(kind: str, m: Column, base: Column, before: Column) -> list[Column]:
    digits = _digits(m)
    n = F.length(digits)
    if kind == "email":
        tld = F.lower(F.regexp_extract(m, r"([A-Za-z0-9-]+)$", 1))
        gaz = _vote(tld.isin(*TLDS), ~tld.rlike("^[a-z]{2,24}$"))
        shape = _vote(F.length(m).between(6, 80) & ~m.rlike(r"^[.]|\.\."), F.length(m) > 254)
    elif kind == "ip":
        gaz = _vote(~m.rlike(r"^(?:0|255|127)\."), m.rlike(r"^0\.|^255\."))
        shape = _vote(F.length(m).between(7, 39), F.length(m) > 45)
    elif kind == "card":
        gaz = _vote(digits.rlike(ISSUERS), ~digits.rlike(ISSUERS))
        shape = _vote(n.isin(14, 15, 16), (n < 13) | (n > 19))
    else:
        gaz = _vote(m.rlike(CALLING) | m.rlike(r"^\(?[2-9][0-9]{2}\)?[ .-][2-9]"), m.rlike(r"^\+0|^\+999"))
        shape = _vote(n.between(9, 13), (n < 7) | (n > 15))
    checked = F.when(base, 1).otherwise(-1)
    return [checked.alias("check"), gaz.alias("gazetteer"), _vote(F.lower(before).rlike(CONTEXT[kind])).alias("context"),
            shape.alias("shape")]


def candidates(text: Column) -> Column:
    """Array of candidate spans with their votes and features, by kind, then start."""
    def inner_cards(found, described, kind, k):
        """Card numbers in base matches that fail; the Luhn sum is their check."""
        good = F.filter(found, lambda b: b["base"])
        spans = F.concat(*[matches(text, p) for p in CARDS])
        spans = F.filter(spans, lambda x: ~F.exists(good, lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))
                         & ~F.exists(found, lambda b: (b["s"] == x["s"]) & (b["e"] == x["e"])))
        return F.transform(spans, lambda x: described(x, False, kind, k, lambda m: check(kind, m)))

    def with_inner_cards(found, described, kind, k):
        return let(found, lambda f: F.concat(f, inner_cards(f, described, kind, k)))

    out = []
    for k, kind in enumerate(KINDS):
        def described(x, base, kind, k, checked=None):
            before = x["b"]
            ok = check(kind, x["m"]) if base else F.lit(False)
            marks = F.length(F.regexp_replace(x["m"], "[0-9A-Za-z]", ""))
            return F.struct(F.lit(k).alias("kind"), x["s"].alias("s"), x["e"].alias("e"), ok.alias("base"),
                            *_labels(kind, x["m"], ok if checked is None else checked(x["m"]), before),
                            F.least(F.length(_digits(x["m"])) / 4, F.lit(5)).cast("int").alias("digits"),
                            F.least(marks, F.lit(3)).alias("marks"),
                            F.when(before.rlike("[0-9A-Za-z]$"), 1).otherwise(0).alias("edge"))

        def make(pattern, base, kind=kind, k=k):
            return F.transform(matches(text, pattern), lambda x: described(x, base, kind, k))

        found = make(BASE[kind], True)
        if kind in LOOSE:
            found = F.concat(found, make(LOOSE[kind], False))
        if kind == "card":
            found = with_inner_cards(found, described, kind, k)
        out.append(F.when(text.rlike(GATES[kind]), found))
    return F.concat(*[F.coalesce(c, F.array().cast(_CANDIDATES)) for c in out])


_CANDIDATES = ("array<struct<kind:int,s:int,e:int,base:boolean,check:int,gazetteer:int,context:int,shape:int,"
               "digits:int,marks:int,edge:int>>")


def reliabilities(patterns: dict[tuple, float], rounds: int = 50) -> dict[tuple, float]:
    """EM over vote patterns: pattern -> probability that the span is personal data.

    Starts from the smoothed majority vote; each round re-estimates the
    class share and P(vote | class) of every labeler, then the posteriors.
    """
    post = {p: (1 + sum(v > 0 for v in p)) / (2 + sum(v != 0 for v in p)) for p in patterns}
    for _ in range(rounds):
        share = [1.0, 1.0]
        table = [[defaultdict(lambda: 1.0) for _ in LABELERS] for _ in share]
        for p, n in patterns.items():
            for c, weight in ((1, post[p] * n), (0, (1 - post[p]) * n)):
                share[c] += weight
                for t, v in zip(table[c], p):
                    t[v] += weight

        def logp(c, p):
            return math.log(share[c]) + sum(math.log(t[v] / (share[c] + 2)) for t, v in zip(table[c], p))
        post = {p: 1 / (1 + math.exp(min(700.0, max(-700.0, logp(0, p) - logp(1, p))))) for p in patterns}
    return post


def train_classifier(rows: list[tuple[tuple, float, float]]) -> tuple[float, list[dict[int, float]]]:
    """Naive Bayes log odds (bias, per feature value) from (feature values, count, probability)."""
    total, table = [1.0, 1.0], [[defaultdict(lambda: 1.0) for _ in FEATURES] for _ in range(2)]
    for values, n, p in rows:
        for c, weight in ((1, n * p), (0, n * (1 - p))):
            total[c] += weight
            for t, v in zip(table[c], values):
                t[v] += weight
    seen = [sorted({*a, *b}) for a, b in zip(*table)]
    odds = [{v: math.log(a[v] / (total[1] + len(vs))) - math.log(b[v] / (total[0] + len(vs))) for v in vs}
            for a, b, vs in zip(table[1], table[0], seen)]
    return math.log(total[1] / total[0]), odds


def learn(found: DataFrame) -> dict[int, tuple[float, list[dict[int, float]]]]:
    """kind -> classifier, from the ``candidates`` column of all documents."""
    counts = (found.select(F.explode("candidates").alias("c")).groupBy("c.kind", *[f"c.{f}" for f in FEATURES])
              .agg(F.count("*").alias("n")).collect())  # one row per combination of small values
    models = {}
    for k in sorted({r.kind for r in counts}):
        rows = [(tuple(r[f] for f in FEATURES), float(r.n)) for r in counts if r.kind == k]
        patterns: dict[tuple, float] = defaultdict(float)
        for values, n in rows:
            patterns[values[:len(LABELERS)]] += n
        post = reliabilities(patterns)
        models[k] = train_classifier([(v, n, post[v[:len(LABELERS)]]) for v, n in rows])
    return models


def _taken(acc: Column, c: Column) -> Column:
    """``acc`` and, if it does not touch the last span taken of its kind, ``c``."""
    last = F.try_element_at(acc, F.lit(-1))
    clear = last.isNull() | (last["kind"] != c["kind"]) | (last["e"] <= c["s"])
    return F.when(clear, F.concat(acc, F.array(F.struct(c["kind"].alias("kind"), c["s"].alias("s"), (-c["to"]).alias("e"),
                                                        F.lit(False).alias("base"))))).otherwise(acc)


def accepted(found: Column, models) -> Column:
    """Base spans and the spans that the classifier adds, by kind, then start."""
    def odds(c):
        out = F.lit(-99.0)
        for k, (bias, tables) in models.items():
            value = F.lit(bias)
            for f, table in zip(FEATURES, tables):
                cell = F.lit(0.0)
                for v, w in table.items():
                    cell = F.when(c[f] == v, F.lit(w)).otherwise(cell)
                value = value + cell
            out = F.when(c["kind"] == k, value).otherwise(out)
        return out

    def chosen(of_kind):
        def added(c):
            backed = (c["gazetteer"] > 0) | (c["context"] > 0)
            clear = ~F.exists(F.get(of_kind, c["kind"]), lambda b: (b["s"] < c["e"]) & (c["s"] < b["e"]))
            return ~c["base"] & backed & (odds(c) > 0) & clear

        more = F.array_sort(F.transform(F.filter(found, added), lambda c: F.struct(
            c["kind"].alias("kind"), c["s"].alias("s"), (-c["e"]).alias("to"))))
        more = F.aggregate(more, F.array().cast("array<struct<kind:int,s:int,e:int,base:boolean>>"), _taken)
        base = F.transform(F.flatten(of_kind), lambda c: F.struct(
            c["kind"].alias("kind"), c["s"].alias("s"), c["e"].alias("e"), c["base"].alias("base")))
        return F.array_sort(F.concat(base, more))

    def base_of(k):
        return F.filter(found, lambda c: c["base"] & (c["kind"] == k))

    return let(F.array(*[base_of(k) for k in range(len(KINDS))]), chosen)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id and spans (kind number, s, e, base) of every row."""
    text = F.coalesce("text", F.lit(""))
    found = materialize(docs.select(F.col("doc_id").cast("long"), candidates(text).alias("candidates")), "pii-found")
    return found.select("doc_id", accepted(F.col("candidates"), learn(found)).alias("spans"))


def redact(docs: DataFrame, models=None) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in brackets; null texts stay null."""
    own, taken = docs.columns, {c.lower() for c in docs.columns}
    found, cut = (next(n for n in (f"_{name}{i}" for i in range(len(own) + 1)) if n not in taken) for name in ("found", "cut"))
    docs = materialize(docs.withColumn(found, candidates(F.coalesce("text", F.lit("")))), "pii-documents")  # found once
    if models is None:
        models = learn(docs.select(F.col(found).alias("candidates")))
    spans = F.array_sort(F.transform(accepted(F.col(found), models), lambda c: F.struct(
        c["s"].alias("s"), c["e"].alias("e"), c["kind"].alias("kind"))))
    empty = F.array().cast("array<struct<s:int,e:int,kind:int,gap:int>>")

    def merge(acc, x):  # overlapping spans become one, named by the first
        last = F.element_at(acc, -1)
        end = F.coalesce(F.try_element_at(acc, F.lit(-1))["e"], F.lit(0))
        longer = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(
            last["s"].alias("s"), F.greatest(last["e"], x["e"]).alias("e"), last["kind"].alias("kind"),
            last["gap"].alias("gap"))))
        return F.when((F.size(acc) > 0) & (x["s"] < end), longer).otherwise(F.concat(acc, F.array(F.struct(
            x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"), end.alias("gap")))))

    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    rows = docs.withColumn(cut, F.aggregate(spans, empty, merge))
    last = F.coalesce(F.try_element_at(F.col(cut), F.lit(-1))["e"], F.lit(0))
    parts = F.transform(cut, lambda x: F.concat(F.substring("text", x["gap"] + 1, x["s"] - x["gap"]),
                                                     F.get(names, x["kind"])))
    clean = F.concat(F.array_join(parts, ""), F.substring("text", last + 1, F.length("text")))
    return rows.withColumn("text", F.when(F.size(cut) > 0, clean).otherwise(F.col("text"))).select(
        *[F.col(f"`{c}`") for c in own])


def personal_data_report(docs: DataFrame) -> DataFrame:
    """The digest of ``find_personal_data`` that the query returns."""
    names = F.array(*map(F.lit, KINDS))

    def told(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["s"], x["e"])), ",")

    def count(k):
        return F.size(F.filter(base, lambda x: x["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    base = F.filter("spans", lambda x: x["base"])
    return find_personal_data(docs).select("doc_id", *map(count, range(len(KINDS))),
                                           F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))
