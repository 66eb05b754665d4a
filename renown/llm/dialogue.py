"""Repair of conversation structure with an audit of the cheapest edits.

The rows of a conversation are edited until their roles read
``(s?(ua)+)?``.  A dynamic programme over the rows keeps, for each state
of that pattern, the cheapest edits and of those the ASCII-least audit.

``Audits`` holds the audits of a programme: linked nodes that share their
beginnings, with ancestors 1, 2, 4, ... steps up and rolling hashes, so
that a tie is settled by a search for the longest common beginning.
Beginnings with equal hashes are checked symbol by symbol.

Long conversations are cut, so that no task needs a whole one:

1. Spark range-sorts the rows (digests in place of texts); a task runs the
   programme over blocks of at most ``BLOCK`` rows, from each state that a
   block may begin in to each state that it may end in.
2. A programme over blocks (costs and ranks of their audits, no audits)
   picks a way through the blocks of each conversation.
3. The audits that were picked and the texts are merged by sort order and
   streamed through SHA-256.  That digest is sequential by definition:
   this pass, and no other, reads a conversation in one task, in
   bounded memory but for the audit, which is one value of the result.

Defined results: a null role or text is one space, in the checksum too; a
null turn sorts first; rows of one turn follow each other by role and SHA-256 of
the text; repeated rows are duplicates of each other; a null conv_id is a
conversation of its own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renown.llm.common import crc32_sql
from renown.session import discard, materialize

#: Rows of a block: bounds the audits that a task holds.
BLOCK = 4096
#: Costs of an edit, and of a truncated row that is kept.
RELABEL, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: States of the pattern: nothing yet, after system, after user, after assistant.
START, S, U, A = range(4)
NONE = 1 << 60
LEGAL = ("su", "ua", "au")
SPACE = " \t\n\x0b\x0c\r"
_ORDER = ("k", "turn", "role", "digest")


class Audits:
    """Sequences of symbols as linked nodes; node 0 is the empty one."""

    def __init__(self):
        self.symbol, self.depth, self.hash, self.up = [None], [0], [0], [[]]
        self._equal: set[tuple[int, int]] = set()

    def add(self, node: int, symbol) -> int:
        up = [node]
        while len(up) <= len(self.up[up[-1]]):
            up.append(self.up[up[-1]][len(up) - 1])
        self.symbol.append(symbol)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * 1_000_003 + hash(symbol)) % 2_305_843_009_213_693_951)
        self.up.append(up)
        return len(self.up) - 1

    def lift(self, node: int, steps: int) -> int:
        while steps:
            j = steps.bit_length() - 1
            node, steps = self.up[node][j], steps - (1 << j)
        return node

    def symbols(self, node: int) -> list:
        out = []
        while node:
            out.append(self.symbol[node])
            node = self.up[node][0]
        return out[::-1]

    def same(self, a: int, b: int) -> bool:
        """Whether two nodes of one depth stand for the same symbols; walks to their shared node."""
        pair, x, y = (a, b), a, b
        while x != y and (x, y) not in self._equal:
            if self.symbol[x] != self.symbol[y]:
                return False
            x, y = self.up[x][0], self.up[y][0]
        self._equal.add(pair)
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether a's symbols come before b's."""
        short = min(self.depth[a], self.depth[b])
        x, y = self.lift(a, self.depth[a] - short), self.lift(b, self.depth[b] - short)
        if self.hash[x] != self.hash[y]:
            for j in range(len(self.up[x]) - 1, -1, -1):
                if j < len(self.up[x]) and self.hash[self.up[x][j]] != self.hash[self.up[y][j]]:
                    x, y = self.up[x][j], self.up[y][j]
            if self.same(self.up[x][0], self.up[y][0]):
                return self.symbol[x] < self.symbol[y]
        elif self.same(x, y):
            return self.depth[a] < self.depth[b]
        return self.symbols(a) < self.symbols(b)  # two beginnings with one hash

    def best(self, options: list[tuple[int, int, object]]) -> tuple[int, int] | None:
        """Of (cost, node, symbol to add or None) the cheapest, ties by symbols; None of none."""
        least = min((o[0] for o in options), default=NONE)
        found = None
        for cost, node, symbol in options:
            if cost == least < NONE:
                node = node if symbol is None else self.add(node, symbol)
                if found is None or self.less(node, found):
                    found = node
        return None if found is None else (least, found)


_NEXT = {START: U, S: U, U: A, A: U}
_KEEP = {"s": [(START, S)], "u": [(START, U), (S, U), (A, U)], "a": [(U, A)]}


def delete(audits: Audits, state: list, times: int) -> list:
    """The states after ``times`` rows that have to go."""
    return [x and (x[0] + times * DELETE, audits.add(x[1], "D" * times)) for x in state]


def edit(audits: Audits, state: list, initial: str, truncated: bool) -> list:
    """The states after a row that may stay.  Insertions come right before a row that does:
    before a deleted one they would cost the same and sort later."""
    ready = list(state)
    for to in (U, A):  # any state is at most two insertions away
        ready[to] = audits.best([(x[0], x[1], None) for x in [state[to]] if x] + [
            (x[0] + INSERT, x[1], "I") for s, x in enumerate(ready) if x and _NEXT[s] == to])
    options = [[(x[0] + DELETE, x[1], "D")] if x else [] for x in state]
    extra = TRUNCATED if truncated else 0
    for s, to in _KEEP.get(initial, ()):
        if ready[s]:
            options[to].append((ready[s][0] + extra, ready[s][1], "K"))
    for s, to in _NEXT.items():
        if ready[s]:
            options[to].append((ready[s][0] + RELABEL + extra, ready[s][1], "R"))
    return [audits.best(o) for o in options]


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def batches_of(rows: Iterator[tuple], schema: pa.Schema, size: int = 256) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


class Block:
    """Consecutive rows of a conversation, edited from each state that may come before them."""

    def __init__(self, key: tuple, entries: tuple[int, ...]):
        self.key, self.audits, self.rows = key, Audits(), 0
        self.states = {e: [(0, 0) if s == e else None for s in range(4)] for e in entries}
        self.first = self.last = None
        self.illegal = self.blank = self.duplicate = self.truncated = 0

    def add(self, role: str, copies: int, first: bool, blank: bool, truncated: bool) -> None:
        initial = role[:1]
        if self.rows:
            self.illegal += self.last + initial not in LEGAL
        else:
            self.first = initial
        self.last = initial
        self.illegal += (copies - 1) * (initial * 2 not in LEGAL)
        self.rows += 1
        kept = first and not blank
        self.blank += copies if blank else 0
        self.duplicate += 0 if blank else copies - kept
        self.truncated += kept and truncated
        for e, state in self.states.items():
            if kept:
                state = edit(self.audits, state, initial, truncated)
            if copies > kept:
                state = delete(self.audits, state, copies - kept)
            self.states[e] = state

    def row(self, number: int) -> tuple:
        costs, texts = [NONE] * 16, [None] * 16
        for e, state in self.states.items():
            for s, x in enumerate(state):
                if x:
                    costs[4 * e + s], texts[4 * e + s] = x[0], "".join(self.audits.symbols(x[1]))
        rank = {t: i for i, t in enumerate(sorted({t for t in texts if t is not None}))}
        return (*self.key, number, self.first, self.last, self.illegal, self.blank, self.duplicate, self.truncated,
                costs, [rank.get(t) for t in texts], texts)


_BLOCK_TYPE = ("k string, turn {turn}, role string, digest binary, block long, first string, last string, illegal long, "
               "blank long, duplicate long, truncated long, costs array<long>, ranks array<long>, texts array<string>")


def block_rows(rows: Iterator[tuple], task: int, limit: int) -> Iterator[tuple]:
    """Blocks of the sorted rows of a task.  Only a task's first rows may go on a conversation of the task before."""
    block, number, known = None, task << 33, False
    for k, turn, role, digest, copies, first, blank, truncated in rows:
        if block is None or block.key[0] != k or block.rows >= limit:
            if block is not None:
                yield block.row(number)
                number += 1
                known = known or block.key[0] != k
            opening = known and block.key[0] != k
            block = Block((k, turn, role, digest), (START,) if opening else (START, S, U, A))
        block.add(role, copies, first, blank, truncated)
    if block is not None:
        yield block.row(number)


def pick_ways(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(block, pick, tail, cost, illegal) for the sorted blocks of whole conversations.

    ``tail`` (edits after the last row), cost and pairs of illegal neighbours are given with the last block.
    """
    def ended():
        finals = [(x[0] + INSERT * n, x[1], s) for s, n in ((START, 0), (A, 0), (U, 1), (S, 2)) if (x := state[s])]
        cost, node, s = min(finals, key=lambda f: f[0])
        for f in finals:
            if f[0] == cost and f[1] != node and audits.less(f[1], node):
                node, s = f[1], f[2]
        ways, at = [], node
        while at:
            ways.append(way[at])
            at = audits.up[at][0]
        for i, (block, pick) in enumerate(reversed(ways)):
            last = i == len(ways) - 1
            yield (block, pick, "I" * {U: 1, S: 2}.get(s, 0) if last else "", cost if last else None,
                   illegal if last else None)

    conversation = None
    for k, block, first, last, within, costs, ranks in rows:
        if conversation is None or conversation[0] != k:
            if conversation is not None:
                yield from ended()
            audits, way, illegal, state = Audits(), {}, 0, [(0, 0), None, None, None]
            conversation = (k, None)
        if conversation[1] is not None:
            illegal += conversation[1] + first not in LEGAL
        illegal += within
        conversation = (k, last)
        after = []
        for to in range(4):
            options = [(x[0] + costs[4 * e + to], x[1], (ranks[4 * e + to], e)) for e, x in enumerate(state)
                       if x and costs[4 * e + to] < NONE]
            best = audits.best([(c, n, r) for c, n, (r, _) in options])
            if best:
                entry = next(e for c, n, (r, e) in options
                             if c == best[0] and n == audits.up[best[1]][0] and r == audits.symbol[best[1]])
                way[best[1]] = (block, 4 * entry + to)
            after.append(best)
        state = after
    if conversation is not None:
        yield from ended()


def merge(rows: Iterator[tuple]) -> Iterator[tuple]:
    """One row per conversation from its sorted rows, each block's audit coming before the rows it edits."""
    def line(text: str) -> None:
        sha.update(("\n" if lines[0] else "").encode() + text.encode())
        lines[0] += 1

    def inserts():
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            state = _NEXT[state]
            line("assistant:" if state == A else "user:")
            at += 1

    def ended():
        inserts()
        return (conv, high - low + 1 - turns if turns else 0, *counts, "".join(audits), sha.hexdigest())

    key = None
    for k, turn, role, kind, conv_id, text, times, given, *numbers in rows:
        if key is None or key[0] != k:
            if key is not None:
                yield ended()
            key, conv, sha, lines, audits, audit, at, state = (k,), conv_id, hashlib.sha256(), [0], [], "", 0, START
            counts, turns, low, high = [0] * 5, 0, None, None
        if not kind:
            inserts()
            audit, at = given, 0
            audits.append(given)
            counts = [c + (n or 0) for c, n in zip(counts, numbers)]
            continue
        conv = conv_id
        if times and turn is not None and turn != high:
            low, high, turns = turn if low is None else low, turn, turns + 1
        for _ in range(times):
            inserts()
            edit_, at = audit[at], at + 1
            if edit_ != "D":
                state = {"s": S, "u": U, "a": A}[role[:1]] if edit_ == "K" else _NEXT[state]
                line(f"{role if edit_ == 'K' else 'assistant' if state == A else 'user'}:{text}")
    if key is not None:
        yield ended()


def damaged(conversations: DataFrame) -> DataFrame:
    """Every row as the contract damages it; ``times`` is how often it is there (0: dropped)."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), space))
    act, text = F.crc32(key) % 20, F.coalesce("text", space)
    rows = conversations.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("k"), "conv_id", "turn",
        F.when(act == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(act.isin(0, 1), "").when(act == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(act == 0, 0).when(act == 3, 2).otherwise(1).alias("times"))
    return rows.withColumn("digest", F.unhex(F.sha2("text", 256)))


def repair(rows: DataFrame, limit: int = BLOCK) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of each conversation.

    ``rows``: (k, conv_id, turn, role, text, times, digest), k being a never-null form of conv_id.
    """
    turn = rows.schema["turn"].dataType.simpleString()
    end = F.rtrim(F.col("text"), F.lit(SPACE))
    kinds = materialize(rows.filter("times > 0").groupBy(*_ORDER).agg(
        F.sum("times").alias("copies"), F.first(end == "").alias("blank"),
        F.first(~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("truncated")), "dialogue-rows")
    # the smallest turn, null being less than any
    seen = materialize(kinds.groupBy("k", "role", "digest").agg(F.min(F.struct("turn")).alias("t")), "dialogue-first")
    marked = kinds.join(seen, ["k", "role", "digest"]).select(
        *_ORDER, "copies", F.col("turn").eqNullSafe(F.col("t.turn")).alias("is_first"), "blank", "truncated")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block_type = _BLOCK_TYPE.format(turn=turn)

    def cut(batches):
        task = TaskContext.get().partitionId()
        return batches_of(block_rows(rows_of(batches), task, limit), block_schema, 64)

    def choose(batches):
        return batches_of(pick_ways(rows_of(batches)), pick_schema)

    def finish(batches):
        return batches_of(merge(rows_of(batches)), out_schema)

    types = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8()}
    many = pa.list_(pa.int64())
    block_schema = pa.schema([("k", pa.string()), ("turn", types[turn]), ("role", pa.string()), ("digest", pa.binary()),
                              ("block", pa.int64()), ("first", pa.string()), ("last", pa.string())]
                             + [(c, pa.int64()) for c in ("illegal", "blank", "duplicate", "truncated")]
                             + [("costs", many), ("ranks", many), ("texts", pa.list_(pa.string()))])
    pick_schema = pa.schema([("block", pa.int64()), ("pick", pa.int32()), ("tail", pa.string()), ("cost", pa.int64()),
                             ("illegal", pa.int64())])
    blocks = materialize(marked.repartitionByRange(parts, *_ORDER).sortWithinPartitions(*_ORDER)
                         .mapInArrow(cut, block_type), "dialogue-blocks")
    picks = materialize(blocks.select("k", "block", "first", "last", "illegal", "costs", "ranks").repartition(parts, "k")
                        .sortWithinPartitions("k", "block")
                        .mapInArrow(choose, "block long, pick int, tail string, cost long, illegal long"), "dialogue-picks")
    audits = blocks.drop("illegal").join(picks, "block").select(
        *_ORDER, F.lit(0).alias("kind"), F.lit(None).cast(rows.schema["conv_id"].dataType).alias("conv_id"),
        F.lit(None).cast("string").alias("text"), F.lit(0).alias("times"),
        F.concat(F.element_at("texts", F.col("pick") + 1), F.col("tail")).alias("given"),
        "blank", "duplicate", "truncated", "illegal", "cost")
    none = F.lit(None).cast("long")
    body = rows.select(*_ORDER, F.lit(1).alias("kind"), "conv_id", "text", "times",
                       F.lit(None).cast("string").alias("given"),
                       *[none.alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")])
    names = ["k", "turn", "role", "kind", "conv_id", "text", "times", "given", "blank", "duplicate", "truncated",
             "illegal", "cost"]
    conv = rows.schema["conv_id"].dataType.simpleString()
    out_schema = pa.schema([("conv_id", types.get(conv, pa.string()))] + [(c, pa.int64()) for c in (
        "gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", pa.string()), ("repaired_sha256", pa.string())])
    out = materialize(body.unionByName(audits).repartition(parts, "k").sortWithinPartitions(*_ORDER, "kind").select(*names)
                      .mapInArrow(finish, f"conv_id {conv}, gaps long, blank long, duplicate long, truncated long, "
                                          "illegal long, cost long, audit string, repaired_sha256 string"), "dialogue-out")
    for written in (kinds, seen, blocks, picks):
        discard(written)
    return out


def repair_report(conversations: DataFrame) -> DataFrame:
    """One row per conv_id of the damaged conversations."""
    return repair(damaged(conversations))


def _sql() -> str:
    """DuckDB form: the programme as a recursive query whose states are texts of nine cost digits and the audit."""
    def add(v, cost, symbol):
        return f"(printf('%09d', substr({v}, 1, 9)::BIGINT + {cost}) || substr({v}, 10) || '{symbol}')"

    def keep(initials, v):
        return f"CASE WHEN r.initial IN ({initials}) THEN {add(v, 'r.extra', 'K')} END"

    new_u = ", ".join([add("d.s2", 3, "D")] + [x for v in ("d.s0", "d.s1", "c.c3")
                                               for x in (keep("'u'", v), add(v, "2 + r.extra", "R"))])
    new_a = f"{add('d.s3', 3, 'D')}, {keep(chr(39) + 'a' + chr(39), 'c.c2')}, {add('c.c2', '2 + r.extra', 'R')}"
    spaces = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""WITH RECURSIVE src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {crc32_sql("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS act FROM conversations),
      rows0 AS (SELECT conv_id, turn, CASE WHEN act = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN act = 1 THEN '' WHEN act = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE WHEN act = 3 THEN [1, 2] ELSE [1] END) AS copy FROM src WHERE act <> 0),
      rows1 AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i
        FROM rows0),
      rows2 AS (SELECT *, rtrim(text, {spaces}) = '' AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS dup,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before, left(role, 1) AS initial,
        right(rtrim(text, {spaces}), 1) NOT IN ('.', '!', '?') AS trunc FROM rows1),
      rows3 AS MATERIALIZED (SELECT *, blank OR dup AS gone, (NOT blank AND NOT dup AND trunc)::INT AS extra FROM rows2),
      dp AS (SELECT DISTINCT conv_id, 0::BIGINT AS i, '000000000' AS s0, NULL::VARCHAR AS s1, NULL::VARCHAR AS s2,
          NULL::VARCHAR AS s3 FROM src
        UNION ALL
        SELECT d.conv_id, r.i, {add('d.s0', 3, 'D')},
          CASE WHEN r.gone THEN {add('d.s1', 3, 'D')} ELSE least({add('d.s1', 3, 'D')}, {keep("'s'", 'd.s0')}) END,
          CASE WHEN r.gone THEN {add('d.s2', 3, 'D')} ELSE least({new_u}) END,
          CASE WHEN r.gone THEN {add('d.s3', 3, 'D')} ELSE least({new_a}) END
        FROM dp d JOIN rows3 r ON r.conv_id IS NOT DISTINCT FROM d.conv_id AND r.i = d.i + 1,
          LATERAL (SELECT least(d.s2, {add('d.s0', 2, 'I')}, {add('d.s1', 2, 'I')}, {add('d.s3', 2, 'I')}) AS c2) b,
          LATERAL (SELECT b.c2 AS c2, least(d.s3, {add('b.c2', 2, 'I')}) AS c3) c),
      ends AS (SELECT conv_id, arg_max(least(s0, s3, {add('s2', 2, 'I')}, {add('s1', 4, 'II')}), i) AS best FROM dp GROUP BY conv_id),
      audits AS (SELECT conv_id, substr(best, 1, 9)::BIGINT AS cost, substr(best, 10) AS audit FROM ends),
      symbols AS (SELECT conv_id, unnest(string_split(audit, '')) AS e, generate_subscripts(string_split(audit, ''), 1) AS p
        FROM audits WHERE audit <> ''),
      placed AS (SELECT *, sum((e <> 'I')::INT) OVER w AS i, sum((e <> 'D')::INT) OVER w AS o FROM symbols
        WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
      lines AS (SELECT p.*, r.role, r.text, max((o = 1 AND e = 'K' AND r.initial = 's')::INT) OVER (PARTITION BY p.conv_id) AS system
        FROM placed p LEFT JOIN rows3 r ON e <> 'I' AND r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i WHERE e <> 'D'),
      repaired AS (SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (o - coalesce(system, 0)) % 2 = 1 THEN 'user' ELSE 'assistant' END
        || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS body FROM lines GROUP BY conv_id),
      counts AS (SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, sum(blank::INT) AS blank,
        sum((dup AND NOT blank)::INT) AS duplicate, sum(extra) AS truncated,
        sum((before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au'))::INT) AS illegal FROM rows3 GROUP BY conv_id)
      SELECT a.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank,
        coalesce(c.duplicate, 0)::BIGINT AS duplicate, coalesce(c.truncated, 0)::BIGINT AS truncated,
        coalesce(c.illegal, 0)::BIGINT AS illegal, a.cost, a.audit, sha256(coalesce(r.body, '')) AS repaired_sha256
      FROM audits a LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM a.conv_id
        LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM a.conv_id"""


SQL = _sql()
