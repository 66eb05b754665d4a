"""The Merkle manifest against a plain recursive tree."""

import hashlib
import zlib

import pytest

from renown.llm import merkle


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row, text):
    cells = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return sha("".join("-" if c is None else f"{len(str(c).encode())}:{c}" for c in cells))


def tree(hashes):
    """(root, for each leaf the (before, after) texts from the leaf up)"""
    paths, at, row = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
    while len(row) > 1:
        for path, i in zip(paths, at):
            lo = i - i % 8
            path.append(("".join(row[lo:i]), "".join(row[i + 1:lo + 8])))
        at = [i // 8 for i in at]
        row = [sha("".join(row[i:i + 8])) for i in range(0, len(row), 8)]
    return row[0], paths


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in langs}
    root, tops = tree([subs[g][0] for g in langs])
    out = []
    for g, top in zip(langs, tops):
        for (_, _, h, r), path in zip(sorted(groups[g], key=lambda x: x[:3]), subs[g][1]):
            text = r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            folded = leaf(r, text)
            for before, after in path + top:
                folded = sha(before + folded + after)
            out.append((r["doc_id"], h, subs[g][0], root, sha("".join(a + b for a, b in path + top)), folded, folded == root))
    return out


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, g string, pos long, path string"


@pytest.mark.parametrize("sizes", [{"en": 75, None: 9, "": 1, "é": 8, "z": 64, **{f"l{i}": 2 for i in range(9)}}, {"en": 1}])
def test_manifest(spark, sizes):
    rows, i = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            text = [None, "", "Große TEXTE", f"Lower {i}", "A" * 70_000][i % 5]
            rows.append((i * 37 % 1000, f"s{i % 3}" if i % 4 else None, lang, i if i % 6 else None, text, "g", 1, "p"))
            i += 1
    rows += [(None, None, "en", None, None, "", 0, "")] * 2 + [(5, "s", "en", 1, "Same", "", 0, ""), (5, "s", "en", 1, "Ties", "", 0, "")] * 2
    rows = rows[:1] if len(sizes) == 1 else rows
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = brute([r.asDict() for r in docs.collect()])
    got = [tuple(r) for r in merkle.manifest_report(docs).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    if len(sizes) > 1:
        assert {r[6] for r in got} == {True, False}


def test_empty_table(spark):
    assert merkle.manifest_report(spark.createDataFrame([], SCHEMA)).count() == 0


def test_positions_follow_the_order(spark):
    rows = spark.createDataFrame([(str(i % 2), i // 3, i) for i in range(200)], "g string, k int, v int").repartition(7)
    got = merkle.positions(rows, "k", "v").collect()
    for g in ("0", "1"):
        mine = sorted((r for r in got if r.g == g), key=lambda r: (r.k, r.v))
        assert [r.pos for r in mine] == list(range(100)) and {r.n for r in mine} == {100}
