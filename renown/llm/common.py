"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from renown.session import materialize

#: A written table of at most this many rows (of a few bytes each) may be broadcast.
BROADCAST_ROWS = 200_000
#: One whose rows hold texts or arrays may be if they come to at most this many bytes.
BROADCAST_BYTES = 16 << 20
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table.  Rows hold whole texts, so Python workers get 1000 of them at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(c, UPPER, UPPER.lower())


def words_of(c: Column, separators: str) -> Column:
    """Non-empty pieces between runs of ``separators``; null gives no words."""
    return F.array_remove(F.split(F.coalesce(c, F.lit("")), separators, -1), "")


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a written table of narrow rows) with a broadcast hint if it has few rows.

    Above the bound there is no hint: Spark then shuffles both sides.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def weighed(df: DataFrame, width: Column, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` (a written table) with a broadcast hint if its rows, 32 bytes and ``width`` each, hold at most ``most`` bytes.

    Above the bound both sides are shuffled, however small the files are.
    """
    held = df.agg(F.sum(F.coalesce(width, F.lit(0)).cast("long") + 32)).first()[0] or 0
    return F.broadcast(df) if held <= most else df.hint("merge")


def most_frequent(counts: DataFrame, k: int, *ties: str) -> DataFrame:
    """The ``k`` rows of the written table ``counts`` with the largest ``n``, ties by columns ``ties``.

    A histogram of log counts (a bounded number of rows) gives a lower
    bound first, so what is sorted in one place is little more than k rows
    plus the ties of one bucket, whatever the number of tasks.
    """
    step = F.floor(F.log2("n") * 64)
    need = k
    for r in sorted(counts.groupBy(step.alias("b")).agg(F.count("*").alias("rows")).collect(), reverse=True):
        need -= r.rows
        if need <= 0:
            counts = counts.filter(step >= r.b)
            break
    return counts.orderBy(F.desc("n"), *ties).limit(k)


def doc_key() -> list[Column]:
    """Columns that name a document's content: equal rows share them, null ids too."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("k1"),
            F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("k2")]


def without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose (k1, k2) is not in the written table ``keys``; columns stay as they are."""
    k1, k2 = doc_key()
    out = keys.select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2"))
    return (docs.withColumns({"__k1": k1, "__k2": k2}).join(sized(out), ["__k1", "__k2"], "left_anti")
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def id_text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def crc32_sql(c: str) -> str:
    """DuckDB expression: CRC-32 of the ASCII text ``c``, bit by bit."""
    bits = "list_reduce([xor(crc, byte)] || repeat([0::BIGINT], 8), lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))"
    return (f"xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(string_split({c}, ''), "
            f"lambda d: ascii(d)::BIGINT), lambda crc, byte: {bits}))")


def connected_components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """(node, component) for undirected ``edges`` (u, v) of longs; component is the smallest node.

    Alternating large-star and small-star rounds.  Each round is a min per
    node and a join, written below the checkpoint folder; the minima are
    read back from files, so a hub's edges can be split between tasks.
    Nodes without an edge to another node are not listed.
    """
    def digest(e):
        return tuple(e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)))
                     .first())

    def star(e, large):
        if large:
            near = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:
            near = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = materialize(near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"{name}-min")
        out = near.filter("v > u") if large else near
        out = out.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        return materialize(out.filter("u <> v").dropDuplicates(["u", "v"]), f"{name}-edges")

    edges = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .filter("u <> v").dropDuplicates(["u", "v"]), f"{name}-edges")
    before = digest(edges)
    while before[0]:
        edges = star(star(edges, True), False)
        after = digest(edges)
        if after == before:
            break
        before = after
    pairs = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return pairs.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
                             .dropDuplicates(["node"]))
