"""Cheapest repairs against a search of all edits."""

from __future__ import annotations

import hashlib
import random
import re
from itertools import product

import pytest

from glebe.llm import conversations
from glebe.llm.queries import ORACLES, QUERIES
from tests.compare import ROOT, difference, duck

SCHEMA = "conv_id long, turn long, role string, text string"


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        words = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        out.append("b" if not words else "d" if (role, text) in seen else "t" if words[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """Least (cost, initials, result) over all edits with at most one insertion before each row and two at the end."""
    marks, best = faults(rows), None
    for inserts in product((0, 1), repeat=len(rows) + 1):
        for choice in product(*["D" if m in ("b", "d") else "DKR" for m in marks]):
            for people in product("ua", repeat=sum(inserts) + choice.count("R")):
                who, cost, edits, out = iter(people), 0, "", []
                name = {"u": "user", "a": "assistant"}
                for n, extra in enumerate(inserts):
                    if extra:
                        cost, edits = cost + 5, edits + "I"
                        out.append((name[next(who)], ""))
                    if n < len(rows):
                        c, (role, text) = choice[n], rows[n]
                        edits += c
                        cost += {"K": 0, "R": 1, "D": 2}[c] + (5 if c != "D" and marks[n] == "t" else 0)
                        if c == "K":
                            out.append((role, text))
                        if c == "R":
                            out.append((name[next(who)], text))
                if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "?" for r, _ in out)):
                    found = (cost, edits, "\n".join(f"{r}:{t}" for r, t in out))
                    best = found if best is None else min(best, found)
    return best


def test_cheapest_edits(spark):
    rng = random.Random(5)
    rows, want = [], {}
    for conv in range(160):
        some = [(rng.choice(["user", "assistant", "system", "tool", "user", "assistant", ""]), rng.choice(["Yes.", "No!", "maybe", " ", "a?", "So. \n"])) for _ in range(rng.randrange(1, 5))]
        rows += [(conv, t, *r) for t, r in enumerate(some)]
        want[conv] = (cheapest(some), faults(some), sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(some, some[1:])))
    rng.shuffle(rows)
    out = conversations.repair(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert len(out) == 160
    for r in out:
        (cost, edits, text), marks, illegal = want[r.conv_id]
        assert (r.cost, r.audit) == (cost, edits), rows
        assert r.repaired_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (r.blank, r.duplicate, r.truncated, r.illegal, r.gaps) == (marks.count("b"), marks.count("d"), marks.count("t"), illegal, 0)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_query_equals_sql(spark, sf):
    rel = duck(f"{ROOT}/{sf}").sql(ORACLES["op12_repair_conversations"])
    df = QUERIES["op12_repair_conversations"](spark, f"{ROOT}/{sf}")
    assert difference(df.columns, [tuple(r) for r in df.collect()], rel.columns, rel.fetchall()) is None


def test_odd_rows(spark):
    none = hashlib.sha256(b"").hexdigest()
    rows = [(None, 1, "user", "Hi."), (None, None, "assistant", "Ho."), (1, None, None, None), (2, 5, "user", "A."), (2, 5, "user", "A."), (2, 9, "assistant", "B." * 3_000_000),
            (3, 0, "user", "x."), (1 << 60, 1, "user", "u."), ((1 << 60) + 1, 1, "user", "u.")]
    df = spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA + ", cost string, key string")
    got = {r.conv_id: r for r in conversations.repair(df, present=df.turn.isNull() | (df.turn > 0)).collect()}
    assert set(got) == {None, 1, 2, 3, 1 << 60, (1 << 60) + 1}
    assert (got[None].audit, got[None].cost, got[None].gaps, got[None].illegal) == ("RR", 2, 0, 0)
    assert (got[1].audit, got[1].blank, got[1].gaps) == ("D", 1, 0)
    assert (got[2].audit, got[2].duplicate, got[2].gaps, got[2].cost) == ("KDK", 1, 3, 2)
    assert tuple(got[3])[1:] == (0, 0, 0, 0, 0, 0, "", none)
    assert conversations.repair(df.limit(0)).count() == 0


def test_a_giant_conversation_spills(spark, monkeypatch):
    monkeypatch.setattr(conversations, "HELD", 64)
    rng = random.Random(2)
    rows = [(rng.choice(["user", "assistant"]), f"text {i}" + rng.choice([".", "", "!"])) for i in range(70_000)]
    held, spilled = conversations.Conversation("k", 1 << 30), conversations.Conversation("k", 64)
    for c in (held, spilled):
        for i, (role, text) in enumerate(rows):
            c.add(i, role, text, str(i), False)
    assert spilled.origins._rolled and spilled.texts._rolled and not held.texts._rolled
    a, b = held.close(), spilled.close()
    assert a == b and len(a[7].replace("I", "")) == len(rows)
