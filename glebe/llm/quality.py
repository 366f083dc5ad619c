"""Quality rules as a short-circuit cascade ordered by rejection per cost.

Each rule is a named function of a text's measures that says whether the text is rejected. On a
sample of rows every rule is run on every text: its mean seconds are its cost, its share of rejected
texts its selectivity. The cascade then runs the rules in falling order of rejection per second, each
only on what the earlier ones kept. The order changes the work, never the verdict, since a document
is kept if no rule rejects it; so the sample may be small (``sample_rows``) and timings may vary.

Null and empty texts have no words: all measures are zero and the rule ``few_words`` rejects them.
Repeated rows each get the same verdict. Other columns are kept; the new ones avoid their names.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cached_property, partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glebe.llm.tables import apart

SAMPLE_ROWS = 400
WINDOW = 8
_SYMBOLS = [c.encode() for c in "#*$%&|<>"]
_UPPER = bytes(range(0x41, 0x5B))
_LETTERS = _UPPER + bytes(range(0x61, 0x7B))
_SPACE = b" \t\n\r\x0b\x0c"
_TAILS = bytes(range(0x80, 0xC0))  # continuation bytes of UTF-8


class Text:
    """Measures of one text, each computed when a rule first asks for it."""

    def __init__(self, data: bytes):
        self.data = data

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()  # bytes split at exactly the six ASCII white-space characters

    @property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.data.translate(None, _SPACE + _TAILS))

    @cached_property
    def n_symbols(self) -> int:
        return sum(self.data.count(c) for c in _SYMBOLS)

    @cached_property
    def n_lines(self) -> int:
        return sum(1 for line in self.data.split(b"\n") if line.strip(_SPACE))

    @cached_property
    def n_dup_lines(self) -> int:
        count = Counter(line for line in self.data.split(b"\n") if line.strip(_SPACE))
        return sum(count.values()) - len(count)

    @cached_property
    def n_letters(self) -> int:
        return len(self.data) - len(self.data.translate(None, _LETTERS))

    @cached_property
    def n_upper(self) -> int:
        return len(self.data) - len(self.data.translate(None, _UPPER))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words in windows of eight that the text holds twice or more; exact, by doubling of ranks."""
        if len(self.words) <= WINDOW:
            return 0
        known: dict[bytes, int] = {}
        rank = np.fromiter((known.setdefault(w, len(known)) for w in self.words), np.int64, len(self.words))
        if len(known) == rank.size:
            return 0
        step = 1
        while step < WINDOW:
            pair = rank[:-step] * (int(rank.max()) + 1) + rank[step:]
            rank = np.unique(pair, return_inverse=True)[1]
            step *= 2
        again = np.flatnonzero(np.bincount(rank)[rank] > 1)
        if not again.size:
            return 0
        edge = np.zeros(len(self.words) + 1, np.int64)
        np.add.at(edge, again, 1)
        np.add.at(edge, again + WINDOW, -1)
        return int((np.cumsum(edge)[:-1] > 0).sum())


class Rule(NamedTuple):
    name: str
    rejects: Callable[[Text], bool]


RULES = (
    Rule("few_words", lambda t: t.n_words < 20),
    Rule("repeated_windows", lambda t: 100 * t.n_repeat_words > 30 * t.n_words),
    Rule("symbols", lambda t: 100 * t.n_symbols > 10 * t.word_chars),
    Rule("long_words", lambda t: t.word_chars > 30 * t.n_words),
    Rule("shouting", lambda t: 100 * t.n_upper > 60 * t.n_letters and t.n_letters > 0),
    Rule("repeated_lines", lambda t: 100 * t.n_dup_lines > 60 * t.n_lines),
)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _texts(column: pa.Array) -> Iterator[Text]:
    for v in column.cast(pa.binary()):
        yield Text(v.as_py() or b"")


def _time(batches: Iterator[pa.RecordBatch], rules: tuple[Rule, ...]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for v in batch.column(0).cast(pa.binary()):
            for k, rule in enumerate(rules):
                text = Text(v.as_py() or b"")  # anew, so that no rule is charged for another's measure
                began = time.perf_counter()
                rejected = rule.rejects(text)
                out.append((k, time.perf_counter() - began, float(rejected)))
        k, cost, share = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(k, pa.int32()), pa.array(cost, pa.float64()), pa.array(share, pa.float64())], ["rule", "cost", "share"]
        )


def ordered(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> tuple[Rule, ...]:
    """The rules by falling rejection per second, measured on about ``sample_rows`` rows of ``docs``, drawn in place."""
    sample = docs.select(text).sample(min(1.0, sample_rows / max(1, docs.count())), 17)
    found = sample.mapInArrow(partial(_time, rules=rules), "rule int, cost double, share double").groupBy("rule")
    seen = {r["rule"]: r["share"] / max(r["cost"], 1e-9) for r in found.agg(F.avg("cost").alias("cost"), F.avg("share").alias("share")).collect()}
    return tuple(rules[k] for k in sorted(range(len(rules)), key=lambda k: (-seen.get(k, 0.0), k)))


def _judge(batches: Iterator[pa.RecordBatch], text: str, rules: tuple[Rule, ...], measures: tuple[str, ...], names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        verdicts, values = [], [[] for _ in measures]
        for t in _texts(batch.column(text)):
            verdicts.append(next((r.name for r in rules if r.rejects(t)), None))
            for out, m in zip(values, measures):
                out.append(getattr(t, m))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(verdicts, pa.string()), *(pa.array(v, pa.int64()) for v in values)], [*batch.schema.names, *names]
        )


def judge(
    docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS, measures: tuple[str, ...] = (),
) -> tuple[DataFrame, list[str]]:
    """``docs`` with the first rule that rejects each row (null: kept) and the measures asked for.

    Returns the names of the new columns. Without ``measures`` a rejected text is not read further.
    """
    names = apart(docs, "rejected_by", *measures)
    fields = [T.StructField(names[0], T.StringType()), *(T.StructField(n, T.LongType()) for n in names[1:])]
    job = partial(_judge, text=text, rules=ordered(docs, text, rules, sample_rows), measures=measures, names=names)
    return docs.mapInArrow(job, T.StructType([*docs.schema.fields, *fields])), names


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that a rule rejects."""
    judged, (rejected, *_) = judge(docs, **options)
    return judged.filter(F.col(rejected).isNull()).select(*docs.columns)
