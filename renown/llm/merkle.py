"""Merkle manifest of a dataset by slot pivot.

Every row is a leaf.  The leaves of a group are numbered in order; eight
consecutive nodes make a parent.  One level is one aggregation: a parent's
children are spread over eight slot columns by conditional aggregates,
their concatenation is the parent's input, and the same columns without
a child's own slot are that child's siblings.

Order: a range sort is written with ``monotonically_increasing_id``; the
counts of the ranges before (a row per range and group) turn it into a
position, so no group is ever ranked in one task.  Going up, each level
has an eighth of the rows of the one below.  Going down, a parent hands its
own path to its children by ``explode``; only parents are shuffled.

Defined results: a null column counts as ``-``; a null group is a group of
its own, before all others; leaves with equal doc_id ascend by digest
(equal leaves are interchangeable); a null doc_id comes first and has no
checksum, so its row is not tampered with; an empty table gives no rows;
columns other than the five of a leaf are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from renown.llm.common import ascii_lower, crc32_sql
from renown.session import discard, materialize

FANOUT = 8
_ROW = (1 << 33) - 1
_STEP = "struct<pre:string,post:string>"


def field(c: Column) -> Column:
    """A value as it goes into a leaf: byte count, colon, value; ``-`` for null."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(text: Column) -> Column:
    return F.sha2(F.concat(*[field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], field(text)), 256)


def group_key(c: Column) -> Column:
    """A never-null key that sorts like the group: null first, then by UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def positions(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` (with a column g) plus ``pos``, the place in the group by ``order``, and ``n``, the group's size.

    Two tables are written: the range-sorted rows and the offsets, which
    have one row for each range and group.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = ["g", *order]
    placed = materialize(rows.repartitionByRange(parts, *by).sortWithinPartitions(*by)
                         .withColumn("mid", F.monotonically_increasing_id()), "merkle-order")
    part = F.shiftright("mid", 33)
    ranges = placed.groupBy("g", part.alias("part")).agg(F.count("*").alias("rows"), F.min("mid").alias("first"))
    before = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = materialize(ranges.select(
        "g", "part", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(Window.partitionBy("g")).alias("n")), "merkle-ranges")
    return (placed.withColumn("part", part).join(ranges, ["g", "part"])
            .withColumn("pos", F.col("mid") + F.col("shift")).drop("mid", "part", "shift"))


def _slots() -> list[str]:
    return [f"c{i}" for i in range(FANOUT)]


def _joined(slots: list[str]) -> str:
    return f"concat({', '.join(f"coalesce({s}.h, '')" for s in slots)})"


def parents(nodes: DataFrame) -> DataFrame:
    """One level up: (g, pos, n, h) and the slot columns, for groups of more than one node.

    ``nodes`` has (g, pos, n) and a struct ``c`` with the digest ``h``.
    """
    up = nodes.filter("n > 1").groupBy("g", F.expr(f"pos div {FANOUT}").alias("up")).agg(
        F.first("n").alias("n"),
        *[F.expr(f"max(CASE WHEN pos % {FANOUT} = {i} THEN c END)").alias(s) for i, s in enumerate(_slots())])
    return up.select("g", F.col("up").alias("pos"), F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n"),
                     F.expr(f"sha2({_joined(_slots())}, 256)").alias("h"), *_slots())


def grow(nodes: DataFrame) -> list[DataFrame]:
    """Written levels above ``nodes``, lowest first, until every group has one node."""
    largest = nodes.agg(F.max("n")).first()[0] or 0
    levels: list[DataFrame] = []
    while largest > 1:
        levels.append(materialize(parents(nodes), f"merkle-level{len(levels)}"))
        nodes = levels[-1].select("g", "pos", "n", F.struct("h").alias("c"))
        largest = -(-largest // FANOUT)
    return levels


def tops(nodes: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(g, h, height) of the one node that remains of each group."""
    out = nodes.filter("n = 1").select("g", F.col("c.h").alias("h"), F.lit(0).alias("height"))
    for k, level in enumerate(levels, 1):
        out = out.unionByName(level.filter("n = 1").select("g", "h", F.lit(k).alias("height")))
    return out


def descend(nodes: DataFrame, levels: list[DataFrame], top: DataFrame) -> DataFrame:
    """``nodes`` with what ``top`` has for their group, and ``path`` extended by their own siblings.

    ``top``: (g, height, path, ...), path being what lies above the group.
    A path is an array of (text before, text after) from the lowest level up.
    """
    more = [c for c in top.columns if c not in ("g", "height", "path")]

    def starting(height):
        return top.filter(F.col("height") == height).select("g", F.lit(0).cast("long").alias("pos"), "path", *more)

    known = starting(len(levels))
    for k in range(len(levels) - 1, -1, -1):
        slots = _slots()
        step = [f"""named_struct('slot', {i}, 'c', {s}, 'own',
                    named_struct('pre', {_joined(slots[:i])}, 'post', {_joined(slots[i + 1:])}))"""
                for i, s in enumerate(slots)]
        below = (levels[k].join(known, ["g", "pos"])
                 .select("g", "pos", "path", *more, F.expr(f"explode(array({', '.join(step)})) AS s")).filter("s.c is not null")
                 .select("g", (F.col("pos") * FANOUT + F.col("s.slot")).alias("pos"), F.col("s.c").alias("c"),
                         F.concat(F.array("s.own"), F.col("path")).alias("path"), *more))
        if k == 0:
            lone = nodes.filter("n = 1").select("g", "pos", "c").join(starting(0), ["g", "pos"])
            return below.unionByName(lone)
        known = below.drop("c").unionByName(starting(k))
    return nodes.select("g", "pos", "c").join(known, ["g", "pos"])


def proof(path: Column) -> Column:
    """Siblings from the leaf up, left to right, as one text."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["pre"], s["post"])), "")


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and the siblings of ``path`` lead to."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["pre"], h, s["post"]), 256))


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, leaf, tampered_leaf, subroot, root, path): the tree over ``docs``, a subtree for each lang."""
    low = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, ascii_lower(F.col("text"))).otherwise(F.col("text"))
    leaves = docs.select(group_key(F.col("lang")).alias("g"), "lang", "doc_id", leaf_digest(F.col("text")).alias("leaf"),
                         leaf_digest(low).alias("tampered_leaf"))
    nodes = positions(leaves, "doc_id", "leaf").select(
        "g", "pos", "n", F.struct(F.col("leaf").alias("h"), "tampered_leaf", "doc_id", "lang").alias("c"))
    levels = grow(nodes)
    subtrees = materialize(tops(nodes, levels), "merkle-tops")
    subroots = positions(subtrees.select(F.lit("").alias("g"), F.col("g").alias("sub"), "h", "height"), "sub").select(
        "g", "pos", "n", F.struct("h", "sub", "height").alias("c"))
    upper = grow(subroots)
    nothing = F.array().cast(f"array<{_STEP}>")
    root = tops(subroots, upper).select("g", "height", nothing.alias("path"), F.col("h").alias("root"))
    top = materialize(descend(subroots, upper, root).select(
        F.col("c.sub").alias("g"), "c.height", "path", F.col("c.h").alias("subroot"), "root"), "merkle-subroots")
    for written in (subtrees, *upper):
        discard(written)
    return descend(nodes, levels, top).select("c.doc_id", "c.lang", F.col("c.h").alias("leaf"), "c.tampered_leaf",
                                              "subroot", "root", "path")


def manifest_report(docs: DataFrame) -> DataFrame:
    """One row per document: digests, digest of the proof, and the check of the (partly tampered) document."""
    folded = fold(F.col("tampered_leaf"), F.col("path"))
    return manifest(docs).select(
        "doc_id", "leaf", "subroot", "root", F.sha2(proof(F.col("path")), 256).alias("proof_sha256"),
        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql(levels: int = 9) -> str:
    """DuckDB form, for groups of up to 8^levels documents."""
    def enc(c):
        return f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')"

    def leaf(text):
        return f"sha256({' || '.join([enc(c) for c in ('doc_id', 'source', 'lang', 'n_chars')] + [enc(text)])})"

    others = "coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos {} n.pos), '')"
    out = [f"""d0 AS MATERIALIZED (SELECT doc_id, lang, {leaf('text')} AS leaf,
        CASE WHEN {crc32_sql('doc_id::VARCHAR')} % 3 = 0
             THEN {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
             ELSE {leaf('text')} END AS bad FROM documents),
      d AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
        FROM d0),
      a0 AS MATERIALIZED (SELECT lang, pos, leaf AS h FROM d),
      p0 AS MATERIALIZED (SELECT doc_id, lang, pos AS leaf_pos, leaf, bad AS folded, pos, '' AS proof FROM d)"""]

    def tree(a, p, key, same, steps):
        for k in range(steps):
            b, q = f"{a}{k + 1}", f"{p}{k + 1}"
            out.append(f"""{a}{k}n AS MATERIALIZED (SELECT x.*, count(*) OVER (PARTITION BY {key}) AS n FROM {a}{k} x),
      {b} AS MATERIALIZED (SELECT {key}, CASE WHEN n = 1 THEN 0 ELSE pos // 8 END AS pos,
        CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h
        FROM {a}{k}n GROUP BY {key}, CASE WHEN n = 1 THEN 0 ELSE pos // 8 END),
      {a}{k}s AS MATERIALIZED (SELECT {', '.join('n.' + c for c in key.split(', '))}, n.pos, n.n,
        {others.format('<')} AS pre, {others.format('>')} AS post
        FROM {a}{k}n n JOIN {a}{k}n s ON {same('n', 's')} AND n.pos // 8 = s.pos // 8 GROUP BY ALL),
      {q} AS MATERIALIZED (SELECT p.* EXCLUDE (pos, proof, folded), CASE WHEN s.n = 1 THEN 0 ELSE p.pos // 8 END AS pos,
        CASE WHEN s.n = 1 THEN p.folded ELSE sha256(s.pre || p.folded || s.post) END AS folded,
        p.proof || s.pre || s.post AS proof FROM {p}{k} p JOIN {a}{k}s s ON {same('p', 's')} AND p.pos = s.pos)""")

    tree("a", "p", "lang", lambda x, y: f"{x}.lang IS NOT DISTINCT FROM {y}.lang", levels)
    out.append(f"""u AS MATERIALIZED (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos
        FROM a{levels}),
      b0 AS MATERIALIZED (SELECT 0 AS one, pos, h FROM u),
      q0 AS MATERIALIZED (SELECT p.* EXCLUDE (pos), u.h AS subroot, 0 AS one, u.pos AS pos
        FROM p{levels} p JOIN u ON p.lang IS NOT DISTINCT FROM u.lang)""")
    tree("b", "q", "one", lambda x, y: f"{x}.one = {y}.one", 4)
    return f"""WITH {', '.join(out)}
      SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = h AS verified
      FROM q4, b4"""


SQL = _sql()
