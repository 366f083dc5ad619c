"""Fingerprints, links and components against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from glebe.llm import simhash
from glebe.llm.queries import QUERIES
from tests.compare import ROOT

SF = f"{ROOT}/sf0.001"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_print(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_parts(values):
    values = sorted(values)
    parent = {v: v for v in values}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                parent[root(a)] = root(b)
    return {v: root(v) for v in values}


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = {r.doc_id: plain_print(r.text) for r in docs}
    part = plain_parts(set(prints.values()))
    least = {}
    for i, v in prints.items():
        least[part[v]] = min(i, least.get(part[v], i))
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op11_simhash"](spark, SF).collect()}
    assert got == {i: (f"{v:016x}", least[part[v]]) for i, v in prints.items()}


def test_odd_rows(spark):
    long = " ".join(f"w{i % 997}x{i % 31}" for i in range(400_000))
    rows = [(1, None, "a", "b"), (2, "", "a", "b"), (3, " \n\t", None, None), (4, "One two", "a", "b"), (5, "one two", "a", "b"), (6, long, "a", "b"),
            (None, "one  two", "a", "b"), (7, "x" * (3 << 20) + " y z", "a", "b"), (4, "One two", "a", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, rows string")
    found, (value, part) = simhash.find(docs)
    assert found.columns == ["doc_id", "fingerprint", "rows", value, part]
    got = [(r["doc_id"], r[value] & (1 << 64) - 1, r[part]) for r in found.collect()]
    want = {i: plain_print(t) for i, t, *_ in rows}
    assert len(got) == len(rows) and all(v == want[i] for i, v, _ in got)
    assert {i: p for i, _, p in got} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, None: 4, 6: 6, 7: 7}
    assert simhash.find(docs.limit(0))[0].count() == 0


def test_pieces_do_not_change_a_fingerprint(monkeypatch):
    text = " ".join(f"Word{i * i % 71}" for i in range(500)) + "  é x"
    want = plain_print(text)
    for size in (1, 7, 100, 1 << 20):
        monkeypatch.setattr(simhash, "PIECE", size)
        assert simhash.fingerprint(text.encode()) == want


def clusters(seed, many):
    rng = random.Random(seed)
    out = set()
    for _ in range(many):
        v = rng.getrandbits(64)
        for _ in range(rng.choice([1, 3, 60])):
            out.add(v)
            for _ in range(rng.choice([1, 2, 2, 3])):
                v ^= 1 << rng.randrange(64)
    base = rng.getrandbits(64)
    return out | {base ^ rng.getrandbits(14) for _ in range(300)} | {base ^ (rng.getrandbits(8) << 40) ^ (rng.getrandbits(8) << 8) for _ in range(300)}


@pytest.mark.parametrize("long", [1, 5, 1 << 20])
def test_links_lose_nothing(spark, monkeypatch, long):
    monkeypatch.setattr(simhash, "LONG", long)
    values = clusters(long, 25)
    part = plain_parts(values)
    signed = {v: v - (1 << 64) if v >> 63 else v for v in values}
    prints = spark.createDataFrame([(s,) for s in signed.values()], "value long")
    rows = [(r["a"], r["b"]) for r in simhash.links(prints).collect()]
    back = {s: v for v, s in signed.items()}
    for a, b in rows:
        assert part[back[a]] == part[back[b]]
    labels = {r["node"]: r["part"] for r in simhash.components(spark.createDataFrame(rows, "a long, b long")).collect()}
    groups = {}
    for v in values:
        groups.setdefault(part[v], set()).add(labels.get(signed[v], signed[v]))
    assert all(len(g) == 1 for g in groups.values()) and len(set().union(*groups.values())) == len(groups)


def test_long_lists_stream_over_batches(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(simhash, "LONG", 4)
    key = np.repeat(np.arange(6), [3, 9, 1, 2, 12, 4])
    value = np.arange(key.size) % 4 + 1000 * key
    batches = [pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int8)), pa.array(key[i : i + n]), pa.array(value[i : i + n])], ["kind", "key", "value"])
               for i, n in [(k, min(2, key.size - k)) for k in range(0, key.size, 2)]]
    rows = [r for b in simhash._search(iter(batches), bounded=False) for r in b.to_pylist()]
    passed = sorted(r["key"] for r in rows if r["kind"] >= 0)
    assert passed == [1] * 9 + [4] * 12
    assert {r["a"] // 1000 for r in rows if r["kind"] < 0} == {0, 3, 5}


def test_looked_up_equals_all_pairs():
    rng = np.random.default_rng(3)
    low = rng.choice(1 << 16, 900, replace=False).astype(np.uint64)
    value = np.uint64(0xAB00CD0012345678) ^ (low & np.uint64(255)) ^ ((low >> np.uint64(8)) << np.uint64(32))
    a, b = simhash.looked_up(value)
    want = {(i, j) for i in range(900) for j in range(900) if i != j and (int(value[i]) ^ int(value[j])).bit_count() <= 2}
    assert set(zip(a.tolist(), b.tolist())) == want
    left, right = simhash.tallied(np.zeros(900, int), value)
    assert {(i, j) for i, j in zip(left.tolist(), right.tolist())} == {(i, j) for i, j in want if i < j}
