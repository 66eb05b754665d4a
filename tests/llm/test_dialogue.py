"""Conversation repair against an exhaustive search, and the audits it compares."""

import hashlib
import random
import re
import zlib

import pytest

from renown.llm import dialogue
from renown.llm.dialogue import Audits

BLANK, ENDS = r"[^\x20\x09-\x0D]", " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        act = zlib.crc32(key.encode()) % 20
        if act:
            text = "" if act == 1 else re.sub("[.!?]", "", text) if act == 2 else text
            out += [(turn, "user" if act == 4 else role, text)] * (2 if act == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))


def cheapest(rows):
    """(cost, audit, lines) by trying every edit: only legal states are followed, nothing is compared before the end."""
    faults = []
    for i, (_, role, text) in enumerate(rows):
        faults.append("B" if not re.search(BLANK, text) else "D" if any(r[1:] == (role, text) for r in rows[:i])
                      else "T" if text.rstrip(ENDS)[-1] not in ".!?" else "")
    best = []

    def go(i, state, cost, audit, lines):
        if i == len(rows) and state in ("", "a"):
            best.append((cost, audit, lines))
        for to in ("user", "assistant"):
            legal = to == "assistant" if state == "u" else to == "user"
            if legal and not audit.endswith("III"):
                go(i, to[0], cost + 2, audit + "I", [*lines, f"{to}:"])
        if i == len(rows):
            return
        _, role, text = rows[i]
        go(i + 1, state, cost + 3, audit + "D", lines)
        if faults[i] in "T":
            more = faults[i] == "T"
            if role[:1] and role[:1] in {"": "su", "s": "u", "u": "a", "a": "u"}[state]:
                go(i + 1, role[:1], cost + more, audit + "K", [*lines, f"{role}:{text}"])
            to = "assistant" if state == "u" else "user"
            go(i + 1, to[0], cost + 2 + more, audit + "R", [*lines, f"{to}:{text}"])

    go(0, "", 0, "", [])
    return min(best), faults


def brute(table):
    out = []
    for conv in {r[0] for r in table}:
        rows = damage([r for r in table if r[0] == conv])
        (cost, audit, lines), faults = cheapest(rows)
        turns = {r[0] for r in rows if r[0] is not None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("B"), faults.count("D"),
                    faults.count("T"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


SCHEMA = "conv_id long, turn long, role string, text string, k string, times int, kind string"


def odd_rows():
    draw = random.Random(7)
    rows = []
    for conv in range(60):
        for turn in range(draw.randrange(1, 6)):
            role = draw.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None])
            text = draw.choice(["Yes.", "Yes.", "No", " \t\n", "", None, f"Why {conv}?", "Ünï. \n", "x" * 9000 + "!"])
            rows.append((conv, draw.choice([turn, turn, turn * 3, None, 0]), role, text))
    return rows + [(None, 1, "user", "Hi."), (None, None, None, None), (None, 1, "user", "Hi."), (7, 0, "user", "Yes.")] * 2


@pytest.mark.parametrize("limit", [2, dialogue.BLOCK])
def test_repair(spark, limit):
    rows = [r for c in {r[0] for r in odd_rows()} for r in [x for x in odd_rows() if x[0] == c][:6]]
    data = spark.createDataFrame([(*r, "clash", 3, "z") for r in rows], SCHEMA).repartition(4)
    got = sorted((tuple(r) for r in dialogue.repair(dialogue.damaged(data), limit).collect()), key=str)
    assert got == brute(rows)


def test_long_conversation_does_not_depend_on_blocks(spark):
    draw = random.Random(3)
    rows = [(1, i, draw.choice(["user", "assistant", "system"]), draw.choice(["A.", f"b{i}", f"c{i}.", " "]), "", 0, "") for i in range(700)]
    data = spark.createDataFrame(rows + [(1, 800, "user", "same.", "", 0, "")] * 300, SCHEMA)
    few, many = (dialogue.repair(dialogue.damaged(data), n).collect() for n in (5000, 7))
    assert few == many and len(few[0].audit) >= 900


def test_empty_and_all_dropped(spark):
    assert dialogue.repair_report(spark.createDataFrame([], SCHEMA)).count() == 0
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    row = dialogue.repair_report(spark.createDataFrame([(conv, 0, "user", "x", "", 0, "")], SCHEMA)).collect()
    assert [tuple(r) for r in row] == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


@pytest.mark.parametrize("collide", [False, True])
def test_audits_compare_like_their_symbols(collide):
    draw, audits, nodes = random.Random(1), Audits(), [0]
    for _ in range(400):
        nodes.append(audits.add(draw.choice(nodes[-20:]), draw.choice("DIK")))
    if collide:  # every hash alike: each answer has to come from the check
        audits.hash = [0] * len(audits.hash)
    for _ in range(3000):
        a, b = draw.choice(nodes), draw.choice(nodes)
        assert audits.less(a, b) == (audits.symbols(a) < audits.symbols(b))
