"""SimHash near-duplicates: a byte-position inverted index with count filtering finds all linked fingerprints.

The fingerprint of a text has a bit set if over half the hashes (XXH64, seed 42) of its runs of three words
have it; words stand between ASCII white space, A-Z is lower-cased. Two fingerprints link if at most
``BITS`` = 2 of 64 bits differ. Linked ones differ in at most two of their eight bytes, so they share at
least ``LEAST`` = 6 positional bytes (position, value): the guaranteed minimum matches.

1. Equal fingerprints are one, with the least document id.
2. Index: two of four blocks of two positions are equal in every linked pair, so each fingerprint is posted
   under its positional bytes in each of the six pairs of blocks (lists of single bytes would hold a 256th
   of all fingerprints each). In a list the shared positional bytes of each pair are tallied; pairs that
   reach the minimum are verified bit by bit.
3. A list of over ``LONG`` fingerprints is posted anew instead, under six positional bytes: the four it has
   and each two of the others, since a pair that reaches the minimum shares two of these as well. Such a list
   has at most 2^16 members, however many documents there are, and its links are looked up: each member
   has 136 neighbours within two bits of its free bytes. This way no list lists its pairs.
4. A list passes on one row per linked fingerprint, which connects the same ones; components are the least
   fingerprints' labels spread over these rows.

Null, empty and blank texts have fingerprint zero and link like any other. Repeated rows have one
fingerprint and one component. The component of fingerprints whose documents have no id is null. Long texts are
hashed in pieces of about a megabyte. An empty table gives an empty result. Other columns are kept; the new
ones avoid their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glebe.llm.near import components
from glebe.llm.tables import apart, join_spread, released, stored

SHINGLE = 3
SEED = 42
BITS = 2
POSITIONS = 8
LEAST = POSITIONS - BITS
LONG = 256
PIECE = 1 << 20

U64 = np.uint64
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: two of four blocks of two positions; the other four positions
LISTS = [((*a, *b), tuple(sorted({*range(POSITIONS)} - {*a, *b}))) for a, b in combinations([(0, 1), (2, 3), (4, 5), (6, 7)], 2)]
#: bit patterns of one or two bits over two bytes
NEAR = np.array([sum(1 << i for i in c) for n in range(1, BITS + 1) for c in combinations(range(16), n)], np.int64)


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists that overlap by one word less than a shingle has."""
    at, tail = 0, []
    while at < len(text):
        cut = _SPACE.search(text, at + PIECE) if at + PIECE < len(text) else None
        to = cut.start() if cut else len(text)
        words = tail + text[at:to].lower().split()
        yield words
        tail, at = words[-(SHINGLE - 1) :], to
    if not text:
        yield []


def fingerprint(text: bytes) -> int:
    ones, total = np.zeros(64, np.int64), 0

    def add(hashes: list[int]) -> int:
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones[:] += bits.sum(axis=0, dtype=np.int64)
        return len(hashes)

    words: list[bytes] = []
    for words in _pieces(text):
        if len(words) >= SHINGLE:
            size = np.fromiter(map(len, words), np.int64, len(words)) + 1
            begin = np.cumsum(size) - size
            joined = b" ".join(words)
            end = begin[SHINGLE - 1 :] + size[SHINGLE - 1 :] - 1
            total += add([xxhash.xxh64_intdigest(joined[i:j], SEED) for i, j in zip(begin.tolist(), end.tolist())])
    if not total and words:
        total = add([xxhash.xxh64_intdigest(b" ".join(words), SEED)])
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big") if total else 0


def _prints(batches: Iterator[pa.RecordBatch], text: str, name: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [fingerprint(t.as_py() or b"") for t in batch.column(text).cast(pa.large_binary())]
        columns = [n for n in batch.schema.names if n != text]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in columns), pa.array(np.array(found, U64).view(np.int64))], [*columns, name]
        )


def posting(value: Column, positions: tuple[int, ...], kind: int) -> Column:
    """The positional bytes of a fingerprint as one number, below the number of the list's kind."""
    mask = sum(0xFF << (8 * p) for p in positions)
    kept = value.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))
    return F.struct(F.lit(kind).cast("byte").alias("kind"), kept.alias("key"), value.alias("value"))


def _bytes(value: np.ndarray) -> np.ndarray:
    return value.astype("<u8").view(np.uint8).reshape(-1, POSITIONS)


def tallied(group: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the linked pairs inside each run of equal ``group``: shared bytes counted, then bits compared."""
    left, right = [], []
    octets = _bytes(value)
    here = np.arange(value.size)
    for apart_by in range(1, value.size):
        here = here[here + apart_by < value.size]
        here = here[group[here] == group[here + apart_by]]
        if not here.size:
            break
        there = here + apart_by
        enough = np.flatnonzero((octets[here] == octets[there]).sum(axis=1) >= LEAST)
        linked = enough[np.bitwise_count(value[here[enough]] ^ value[there[enough]]) <= BITS]
        left.append(here[linked])
        right.append(there[linked])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def looked_up(value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the linked pairs of fingerprints that differ in two bytes at most, without comparing them all."""
    octets = _bytes(value)
    free = np.flatnonzero((octets != octets[0]).any(axis=0))
    free = np.append(free, [p for p in range(POSITIONS) if p not in free][: 2 - free.size]).astype(int)
    low = octets[:, free[0]].astype(np.int64) + 256 * octets[:, free[1]].astype(np.int64)
    place = np.full(1 << 16, -1)
    place[low] = np.arange(value.size)
    left, right = [], []
    for bits in NEAR:
        other = place[low ^ bits]
        mine = np.flatnonzero(other >= 0)
        left.append(mine)
        right.append(other[mine])
    return np.concatenate(left), np.concatenate(right)


def _spanning(size: int, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One row per linked place, to the least place of its part."""
    label = np.arange(size)
    while True:
        new = label.copy()
        np.minimum.at(new, left, label[right])
        np.minimum.at(new, right, label[left])
        new = new[new]
        if (new == label).all():
            break
        label = new
    mine = np.flatnonzero(label != np.arange(size))
    return mine, label[mine]


_LINKED = "kind byte, key long, a long, b long"


def _rows(kind, key, a, b) -> pa.RecordBatch:
    n = len(a)
    wide = lambda x, t: pa.array(np.broadcast_to(np.asarray(x), n).astype(t))
    return pa.RecordBatch.from_arrays(
        [wide(kind, np.int8), wide(key, np.int64), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["kind", "key", "a", "b"]
    )


def _search(batches: Iterator[pa.RecordBatch], bounded: bool) -> Iterator[pa.RecordBatch]:
    """Rows that connect the linked fingerprints of each list; kind -1.

    Lists come sorted. Members of a list that turns out to be long are passed on as they are, with its kind and key,
    unless the list is ``bounded`` by its key.
    """
    names = ("kind", "key", "value")
    held = {n: np.zeros(0, np.int64) for n in names}
    passing = None  # the long list that is being passed on

    def last_list(rows: dict) -> int:
        other = np.flatnonzero((rows["kind"] != rows["kind"][-1]) | (rows["key"] != rows["key"][-1]))
        return int(other[-1]) + 1 if other.size else 0

    def done(rows: dict) -> Iterator[pa.RecordBatch]:
        if not rows["key"].size:
            return
        new = np.append(True, (rows["kind"][1:] != rows["kind"][:-1]) | (rows["key"][1:] != rows["key"][:-1]))
        group, value = np.cumsum(new) - 1, rows["value"].view(U64)
        size = np.bincount(group)
        for g in np.flatnonzero(size > LONG):
            mine = np.flatnonzero(group == g)
            if bounded:
                a, b = _spanning(mine.size, *looked_up(value[mine]))
                yield _rows(-1, 0, value[mine][a], value[mine][b])
            else:
                yield _rows(rows["kind"][mine], rows["key"][mine], value[mine], value[mine])
        short = np.flatnonzero((size[group] <= LONG) & (size[group] > 1))
        a, b = _spanning(short.size, *tallied(group[short], value[short]))
        yield _rows(-1, 0, value[short][a], value[short][b])

    for batch in batches:
        rows = {n: np.concatenate([held[n], batch.column(n).to_numpy(zero_copy_only=False)]) for n in names}
        if not rows["key"].size:
            continue
        if passing is not None:
            on = (rows["kind"] == passing[0]) & (rows["key"] == passing[1])
            value = rows["value"][on].view(U64)
            yield _rows(*passing, value, value)
            rows = {n: x[~on] for n, x in rows.items()}
            if not rows["key"].size:
                held = rows
                continue
            passing = None
        at = last_list(rows)
        yield from done({n: x[:at] for n, x in rows.items()})
        held = {n: x[at:] for n, x in rows.items()}
        if held["key"].size > LONG and not bounded:
            passing = (held["kind"][0], held["key"][0])
            value = held["value"].view(U64)
            yield _rows(*passing, value, value)
            held = {n: x[:0] for n, x in held.items()}
    yield from done(held)


def _sorted_lists(postings: DataFrame) -> DataFrame:
    return postings.repartition("kind", "key").sortWithinPartitions("kind", "key", "value")


def links(prints: DataFrame) -> DataFrame:
    """Rows (a, b) that connect all linked values of ``prints`` (value, distinct)."""
    value = F.col("value")
    short = prints.select(F.inline(F.array(*[posting(value, shared, k) for k, (shared, _) in enumerate(LISTS)])))
    first = stored(_sorted_lists(short).mapInArrow(partial(_search, bounded=False), _LINKED), "simhash-lists")
    pairs = [(k, pair) for k, (_, rest) in enumerate(LISTS) for pair in combinations(rest, 2)]
    anew = F.array(*[
        F.when(F.col("kind") == k, posting(F.col("a"), LISTS[k][0] + pair, n)) for n, (k, pair) in enumerate(pairs)
    ])
    longer = first.filter("kind >= 0").select(F.inline(F.filter(anew, lambda p: p.isNotNull())))
    second = _sorted_lists(longer).mapInArrow(partial(_search, bounded=True), _LINKED)
    found = stored(first.filter("kind < 0").select("a", "b").union(second.select("a", "b")).distinct(), "simhash-links")
    released(first)
    return found


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, tuple[str, str]]:
    """``docs`` without the text, with fingerprint and component; returns the names of the two columns."""
    value, part, rows = apart(docs, "fingerprint", "component_id", "rows")
    kept = [T.StructField(f.name, f.dataType, True) for f in docs.schema.fields if f.name != text]
    schema = T.StructType([*kept, T.StructField(value, T.LongType())])
    printed = stored(docs.mapInArrow(partial(_prints, text=text, name=value), schema), "simhash-prints")
    least = stored(printed.groupBy(F.col(value).alias("value")).agg(F.min(doc_id).alias("least"), F.count("*").alias(rows)), "simhash-values")
    edges = links(least.select("value"))
    labels = components(edges)
    named = least.join(labels.withColumnRenamed("node", "value"), "value", "left").withColumn("part", F.coalesce("part", "value"))
    named = stored(named.select("value", "part", "least", rows), "simhash-named")
    ids = stored(named.groupBy("part").agg(F.min("least").alias(part), F.count("*").alias("n")), "simhash-parts")
    by_value = join_spread(named.drop("least"), ids, "part", "n").select(F.col("value").alias(value), part, rows)
    found = join_spread(printed, stored(by_value, "simhash-parts"), value, rows)
    return found.select(*[f.name for f in kept], value, part), (value, part)


def hexadecimal(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))
