"""Conversation structure repair: secondary-sorted streaming with a dynamic programme over the turns.

A conversation is in order if the initials of its roles read ``(s?(ua)+)?``: perhaps a system turn, then user and
assistant in turn. Its rows are taken by turn (nulls first), equal turns by role and by a fingerprint of
role and text. A row's first fault counts: blank (nothing but ASCII white space), duplicate (role and text seen earlier
in the conversation), truncated (its last other character is not one of ``.!?``). The cheapest
edits are sought: Keep 0, Rerole to user or assistant 1, Delete 2 (required for blank and duplicate rows),
Insert an empty user or assistant turn 5; a truncated row that stays costs 5 more. Of equally cheap edits those
with the ASCII-least initials are taken.

All rows of a conversation go to one partition, sorted by conversation and turn, and stream through ``mapInPandas``.
The state carried across batches is the least cost of each of four automaton states and the order of their edit
strings, which decides ties: strings that have consumed the same rows and end in a row's edit are never prefixes
of each other, so their order stays when both grow. Per row and state one byte says where its best string came from.
These bytes, and the texts for the digest of the result, lie in memory up to ``HELD`` bytes a conversation and beyond
in an unnamed file of the task, so a giant conversation costs disk, not memory (but for the string of its edits).

Duplicates are found beforehand, in a window over (conversation, fingerprint) that moves no text; each comes to the
stream as a mark sorted before the rows of its turn and fingerprint.

Nulls of role and text count as one space. A null conversation is a conversation, a null turn a turn before all others. A row with
another initial, or none, must be reroled or deleted. Conversations all of whose rows are left out (``present`` false)
have zeros, no edits and the digest of an empty text. Repeated rows are duplicates. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

HELD = 1 << 20
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

START, SYSTEM, USER, ASSISTANT = range(4)  # after nothing, s, u, a
#: automaton state after a role's initial
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ENDS = (START, ASSISTANT)
#: the user or assistant turn that fits a state
NEXT = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
EDITS = ("D", "ID", "IK", "IR", "K", "R")  # of one row, in ASCII order
LEGAL = {"su", "ua", "au"}
NEVER = 1 << 60

Best = tuple[tuple[int, ...], tuple[int, ...]]  # costs and order of the strings, by state
BEGIN: Best = ((0, NEVER, NEVER, NEVER), (0, 1, 2, 3))


@lru_cache(None)
def _moves(initial: str, must_go: bool, cut: bool) -> tuple[tuple[int, int, int, int], ...]:
    """(from state, to state, cost, edit) for a row."""
    out = []
    for at in range(4):
        for inserted in (False, True):
            state, cost = (STEP[at, NEXT[at][0]], INSERT) if inserted else (at, 0)
            tries = [("D", state, DELETE)]
            if not must_go:
                stay = TRUNCATED if cut else 0
                if (state, initial) in STEP:
                    tries.append(("K", STEP[state, initial], stay))
                tries.append(("R", STEP[state, NEXT[state][0]], stay + REROLE))
            out += [(at, to, cost + more, EDITS.index("I" * inserted + letter)) for letter, to, more in tries]
    return tuple(out)


@lru_cache(1 << 16)
def advance(best: Best, initial: str, must_go: bool, cut: bool) -> tuple[Best, int, bytes]:
    """The states after a row, costs less their least, that least, and each state's origin."""
    cost, order = best
    found = [(NEVER, 0, 0, 0)] * 4
    for at, to, more, edit in _moves(initial, must_go, cut):
        if cost[at] < NEVER:
            found[to] = min(found[to], (cost[at] + more, order[at], edit, at))
    least = min(f[0] for f in found)
    ranked = sorted(range(4), key=lambda q: (found[q][0] >= NEVER, found[q][1:3]))
    place = [0] * 4
    for n, q in enumerate(ranked):
        place[q] = n
    costs = tuple(f[0] - least if f[0] < NEVER else NEVER for f in found)
    return (costs, tuple(place)), least, bytes(f[3] * len(EDITS) + f[2] for f in found)


class Conversation:
    """One conversation while its rows stream by."""

    def __init__(self, key: str | None, held: int = HELD):
        self.key, self.best, self.cost, self.rows = key, BEGIN, 0, 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns, self.low, self.high = 0, None, None
        self.last, self.marks, self.before, self.at = None, set(), None, object()
        self.origins, self.texts = (tempfile.SpooledTemporaryFile(held) for _ in range(2))

    def add(self, turn: int | None, role: str | None, text: str | None, digest: str, mark: bool) -> None:
        if turn != self.at:
            self.at, self.marks, self.before = turn, set(), None
            if turn is not None:
                self.turns += 1
                self.low, self.high = turn if self.low is None else self.low, turn
        if mark:
            self.marks = {digest}
            return
        role, text = " " if role is None else role, " " if text is None else text
        words = text.rstrip("\x20\t\n\x0b\x0c\r")
        blank, double = not words, digest in self.marks or digest == self.before
        cut = not blank and not double and words[-1] not in ".!?"
        self.before = digest
        self.blank += blank
        self.duplicate += double and not blank
        self.truncated += cut
        initial = role[:1]
        if self.rows:
            self.illegal += self.last + initial not in LEGAL
        self.last = initial
        self.rows += 1
        self.best, least, origin = advance(self.best, initial, blank or double, cut)
        self.cost += least
        self.origins.write(origin)
        for value in (role, text):
            data = value.encode()
            self.texts.write(len(data).to_bytes(8, "little"))
            self.texts.write(data)

    def _edits(self) -> tuple[str, int]:
        """The cheapest edits, read off the origins from the last row to the first, and their cost."""
        costs, order = self.best
        ends = [(costs[q], order[q], "", q) for q in ENDS]
        ends += [(costs[q] + INSERT, order[q], "I", q) for q in range(4) if STEP[q, NEXT[q][0]] in ENDS]
        more, _, last, state = min(ends)
        out = bytearray(last.encode())
        end = self.rows
        while end:
            begin = max(0, end - 65536)
            self.origins.seek(4 * begin)
            block = self.origins.read(4 * (end - begin))
            for i in range(end - begin - 1, -1, -1):
                state, edit = divmod(block[4 * i + state], len(EDITS))
                out += EDITS[edit][::-1].encode()
            end = begin
        out.reverse()
        return out.decode(), self.cost + more

    def _repaired(self, edits: str) -> Iterator[bytes]:
        self.texts.seek(0)
        state = START
        for edit in edits:
            if edit == "I":
                role, text = NEXT[state].encode(), b""
            else:
                role, text = (self.texts.read(int.from_bytes(self.texts.read(8), "little")) for _ in range(2))
                if edit == "D":
                    continue
                if edit == "R":
                    role = NEXT[state].encode()
            state = STEP[state, role[:1].decode()]
            yield role + b":" + text

    def close(self) -> tuple:
        edits, cost = self._edits()
        digest = hashlib.sha256()
        for n, line in enumerate(self._repaired(edits)):
            digest.update(b"\n" + line if n else line)
        self.origins.close()
        self.texts.close()
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (self.key, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, edits, digest.hexdigest())


NUMBERS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_KINDS = ("mark", "row", "absent")


def _stream(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    now: Conversation | None = None
    for frame in frames:
        done = []
        for key, turn, role, text, digest, kind in zip(*(frame[c].tolist() for c in ("key", "turn", "role", "text", "digest", "kind"))):
            if now is None or key != now.key:
                done += [] if now is None else [now.close()]
                now = Conversation(key)
            if kind != 2:
                now.add(None if turn is None else int(turn), role, text, digest, kind == 0)
        yield pd.DataFrame(done, columns=["key", *NUMBERS, "audit", "repaired_sha256"])
    if now is not None:
        yield pd.DataFrame([now.close()], columns=["key", *NUMBERS, "audit", "repaired_sha256"])


def repair(
    rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: Column | None = None
) -> DataFrame:
    """One row per conversation: faults, cost and initials of the cheapest edits, and the digest of what they leave.

    Rows for which ``present`` does not hold only name their conversation.
    """
    said = lambda c: F.coalesce(F.col(c), F.lit(" "))
    here = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    # role and text are told apart by the role's length
    digest = F.md5(F.concat(F.length(said(role)).cast("string"), F.lit(":"), said(role), said(text)))
    spoken = rows.select(
        F.col(conversation).alias("conversation"), F.when(here, F.col(turn)).try_cast("long").alias("turn"), F.when(here, said(role)).alias("role"),
        F.when(here, said(text)).alias("text"), F.when(here, digest).alias("digest"), F.when(here, 1).otherwise(2).alias("kind"),
    )
    nth = F.rank().over(W.partitionBy("conversation", "digest").orderBy(F.col("turn").asc_nulls_first()))
    told = spoken.filter("kind = 1").select("conversation", "role", "digest", "turn").repartition("conversation", "digest")
    seen = told.groupBy("conversation", "role", "digest", "turn").agg(F.lit(0).alias("kind"))
    marks = seen.withColumn("nth", nth).filter("nth > 1").select("conversation", "turn", "role", F.lit(None).cast("string").alias("text"), "digest", "kind")
    order = [F.col("conversation"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest"), F.col("kind")]
    sorted_rows = spoken.unionByName(marks).repartition("conversation").sortWithinPartitions(*order)
    kind = rows.schema[conversation].dataType
    keyed = sorted_rows.select(
        F.col("conversation").cast("string").alias("key"), F.col("turn").cast("string").alias("turn"), "role", "text", "digest", "kind"
    )
    found = keyed.mapInPandas(_stream, "key string, " + ", ".join(f"{n} long" for n in NUMBERS) + ", audit string, repaired_sha256 string")
    return found.select(F.col("key").cast(kind).alias(conversation), *NUMBERS, "audit", "repaired_sha256")
