"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions alone.

An item's windows are its runs of ``window`` words (the whole item if it
has fewer).  A window is a set of word shingles with their places; exact
containment means that all of them are found, so the prefix that has to
match is the single rarest shingle.  Shingles are ordered by how often
they occur in the documents.  A match of the rarest one fixes where the
window would start; length and position bounds drop starts that do not
fit the document, and the words there are compared with the window's.

The documents are read twice: once for the positions of benchmark
shingles (kept as a narrow table; everything else is dropped in the same
pass), once to count words and verify the candidates.

Defined results: null has no words; repeated rows each get their own
result; repeated or null benchmark rows: items are (item_id, text) pairs,
null ids are not named in ``items``; an empty benchmark hits nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from renown.llm.common import ascii_lower, doc_key, sized, weighed, without, words_of
from renown.session import materialize

# Fixed value: what is between words, after lower-casing.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_column(c: Column) -> Column:
    return words_of(ascii_lower(c), SEPARATORS)


def shingle_hash(words: Column, at: Column, n: int) -> Column:
    """Hash of ``n`` words from the 1-based place ``at``."""
    return F.xxhash64(*[F.get(words, at + (i - 1)) for i in range(n)])


def _shingles(words: Column, n: int) -> Column:
    """Hashes of all shingles of ``n`` words, in order."""
    return F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)),
                                                  lambda i: shingle_hash(words, i, n))).otherwise(F.array().cast("array<bigint>"))


def item_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """item_id, wid (a hash of the words), words of each window; equal windows of several items share wid."""
    items = benchmark.select("item_id", words_column(F.col("text")).alias("w")).filter(F.size("w") > 0)
    size = F.least(F.lit(window), F.size("w"))
    starts = F.sequence(F.lit(1), F.size("w") - size + 1)
    wins = items.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, size))).alias("words"))
    return wins.distinct().withColumn("wid", F.sha2(F.array_join("words", " "), 256))


def find_hits(docs: DataFrame, named: DataFrame, window: int = 10, shingle: int = 5) -> DataFrame:
    """(k1, k2, start, len, wid) of every occurrence of a window; k1, k2 name a document's id and text.

    ``named`` is the written table of ``item_windows``.  Which items a
    window belongs to is left to the caller: hits carry its id only.
    """
    wins = materialize(named.select("wid", "words").dropDuplicates(["wid"]), "decon-words")
    lengths = sorted(r.n for r in wins.select(F.least(F.size("words"), F.lit(shingle)).alias("n")).distinct().collect())
    if not lengths:  # an empty benchmark
        return docs.select(*doc_key(), F.lit(0).alias("start"), F.lit(0).alias("len"),
                           F.lit("").alias("wid")).limit(0)
    members = [wins.filter(F.least(F.size("words"), F.lit(shingle)) == n).select(
        "wid", F.size("words").alias("len"), F.lit(n).alias("n"),
        F.posexplode(_shingles(F.col("words"), n)).alias("place", "h")) for n in lengths]
    members = materialize(reduce(DataFrame.unionByName, members), "decon-members")

    known = materialize(members.select("n", "h").distinct(), "decon-shingles")
    known = sized(known)
    words = docs.select(*doc_key(), words_column(F.col("text")).alias("w"))
    places = words.select("k1", "k2", F.explode(F.array(*[
        F.struct(F.lit(n).alias("n"), _shingles(F.col("w"), n).alias("hs")) for n in lengths])).alias("s"))
    found = materialize(places.select("k1", "k2", F.col("s.n").alias("n"), F.posexplode("s.hs").alias("at", "h"))
                        .join(known, ["n", "h"]).select("k1", "k2", "n", "at", "h"), "decon-found")

    counts = found.groupBy("n", "h").agg(F.count("*").alias("freq"))
    by_rarity = Window.partitionBy("wid").orderBy(F.col("freq").asc(), "place")
    prefix = materialize(members.join(counts, ["n", "h"])  # a shingle that never occurs rules its windows out
                         .withColumn("r", F.row_number().over(by_rarity))
                         .withColumn("seen", F.count("*").over(Window.partitionBy("wid")))
                         .filter((F.col("r") == 1) & (F.col("seen") == F.col("len") - F.col("n") + 1))
                         .select("n", "h", "place", "wid", "len"), "decon-prefix")
    starts = materialize(found.join(sized(prefix), ["n", "h"]).withColumn("start", F.col("at") - F.col("place"))
                         .filter("start >= 0").select("k1", "k2", "start", "len", "wid").distinct(), "decon-starts")
    ids = materialize(starts.select("k1", "k2").distinct(), "decon-docs")
    texts = (words.join(sized(ids), ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"]))
    there = (starts.join(texts, ["k1", "k2"]).filter(F.col("start") + F.col("len") <= F.size("w"))
             .select("k1", "k2", "start", "len", "wid", F.expr("slice(w, start + 1, len)").alias("words")))
    return there.join(wins, ["wid", "words"]).select("k1", "k2", "start", "len", "wid")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 5) -> DataFrame:
    """k1, k2, n_hit and items (sorted strings) of documents with hits, as a written table."""
    named = materialize(item_windows(benchmark, window), "decon-windows")
    hits = materialize(find_hits(docs, named, window, shingle), "decon-hits")
    order = Window.partitionBy("k1", "k2").orderBy("start", "len").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("len")
    covered = (hits.withColumn("before", F.coalesce(F.max(end).over(order), F.lit(0)))
               .groupBy("k1", "k2").agg(F.sum(F.greatest(F.lit(0), end - F.greatest("start", "before"))).alias("n_hit")))
    items = (hits.select("k1", "k2", "wid").distinct().join(named.select("wid", "item_id"), "wid")
             .groupBy("k1", "k2").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items")))
    return materialize(covered.join(items, ["k1", "k2"], "left"), "decon-result")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 5) -> DataFrame:
    """doc_id, n_words, n_hit, items (array of strings), contaminated for every row."""
    found = contamination(docs, benchmark, window, shingle)
    base = docs.select(*doc_key(), F.col("doc_id").cast("long"),
                       F.size(words_column(F.col("text"))).cast("long").alias("n_words"))
    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    found = weighed(found, F.octet_length(F.array_join("items", ",")) + 32 * F.size("items"))
    return base.join(found, ["k1", "k2"], "left").select(
        "doc_id", "n_words", hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        (hit > 0).alias("contaminated"))


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 5) -> DataFrame:
    """``docs`` without the rows in which an item's window occurs."""
    return without(docs, contamination(docs, benchmark, window, shingle))


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return decontaminate(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS u, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS t FROM (
    SELECT item_id, w, least(10, len(w)) AS m, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
    FROM b WHERE len(w) > 0)),
hit AS (SELECT u, i, dw.m, item_id FROM (
    SELECT u, m, i, array_to_string(list_slice(w, i, i + m - 1), ' ') AS t FROM (
        SELECT u, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM win) WHERE len(w) >= m)) dw
    JOIN win ON win.t = dw.t AND win.m = dw.m),
n AS (SELECT u, count(DISTINCT p) AS n_hit FROM (SELECT u, unnest(range(i, i + m)) AS p FROM hit) GROUP BY u),
it AS (SELECT u, count(DISTINCT item_id) AS n_items,
    sha256(array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',')) AS s FROM hit GROUP BY u)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(s, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (u) LEFT JOIN it USING (u)
"""
