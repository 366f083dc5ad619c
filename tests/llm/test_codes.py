"""Codes and codebooks against plain integer rounds."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from glebe.llm import codes
from glebe.llm.queries import ORACLES, QUERIES
from tests.compare import ROOT, difference, duck


def plain(vectors, parts=8, entries=16, rounds=6):
    """Codes, errors and codebooks by comparing everything with everything, in Python integers."""
    whole = [[max(-(1 << 40), min(1 << 40, math.floor(x * 4096))) for x in v] for v in vectors]
    out_codes, errors, books = [[] for _ in whole], [0] * len(whole), []
    for a, b in codes.cuts(len(vectors[0]), parts):
        points = [w[a:b] for w in whole]
        book = [list(p) for p in points[:entries]]
        far = lambda p, e: sum((x - y) ** 2 for x, y in zip(p, e))
        pick = lambda p: min(range(len(book)), key=lambda k: (far(p, book[k]), k))
        for _ in range(rounds):
            mine = [pick(p) for p in points]
            book = [
                [sum(c) // mine.count(k) for c in zip(*[p for p, m in zip(points, mine) if m == k])] if k in mine else book[k] for k in range(len(book))
            ]
        for i, p in enumerate(points):
            out_codes[i].append(pick(p))
            errors[i] += far(p, book[out_codes[i][-1]])
        books.append(book)
    return out_codes, [min(e, (1 << 63) - 1) for e in errors], books


def compared(spark, vectors, **options):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    found = codes.compress(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), block=70, **options)
    got = sorted((r["vec_id"], list(r[found.code]), r[found.error]) for r in found.found.collect())
    want_codes, errors, books = plain(vectors)
    assert [b.tolist() for b in found.books] == books
    assert got == [(i, c, e) for i, (c, e) in enumerate(zip(want_codes, errors))]


def test_equal_plain_rounds(spark):
    rng = np.random.default_rng(1)
    compared(spark, rng.normal(0, 0.1, (400, 32)))
    compared(spark, rng.integers(-2, 3, (300, 16)) / 4096)  # many ties
    compared(spark, np.concatenate([rng.normal(c, 0.01, (60, 16)) for c in rng.normal(0, 1, (5, 16))]))
    compared(spark, rng.normal(0, 1e6, (90, 16)))  # beyond doubles' exact squares
    compared(spark, np.zeros((200, 8)))
    compared(spark, rng.normal(0, 1, (5, 19)))  # fewer than entries, uneven parts


def test_balls_are_wholly_owned():
    rng = np.random.default_rng(2)
    points = np.concatenate([rng.normal(c, 10, (300, 4)) for c in rng.normal(0, 3000, (8, 4))]).astype(np.int64)
    tree = codes.plant(points, 16)
    assert sorted(tree.order.tolist()) == list(range(len(points))) and (points[tree.order] == tree.points).all()
    for ball in range(tree.begin.size):
        mine = tree.points[tree.begin[ball] : tree.end[ball]]
        assert (mine.sum(axis=0) == tree.sums[ball]).all()
        assert np.sqrt(((mine - tree.centre[ball]) ** 2).sum(axis=1)).max() <= tree.radius[ball] * (1 + 1e-12)
        if tree.left[ball] >= 0:
            ends = sorted((int(tree.begin[c]), int(tree.end[c])) for c in (tree.left[ball], tree.right[ball]))
            assert ends[0][0] == tree.begin[ball] and ends[0][1] == ends[1][0] and ends[1][1] == tree.end[ball]
    entries = points[::300]
    whole, loose, _ = codes.walk(tree, entries)
    assert loose.size == 0 and len(whole) < 200  # no point was looked at
    entries = points[:16]
    _, loose, _ = codes.walk(tree, entries)
    far = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (codes.assign(tree, entries)[0] == far.argmin(axis=1)).all() and 0 < loose.size < len(points)


def test_anchors_take_what_is_nearer():
    points = np.random.default_rng(4).normal(0, 1, (500, 3))
    groups = codes.anchors(points, np.arange(500), 20)
    assert sorted(np.concatenate(groups).tolist()) == list(range(500)) and len(groups) == 20


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [[float(i + j) for j in range(8)] for i in range(20)]
    rows = [(i, v, None if i % 2 else 1) for i, v in enumerate(good)]
    rows += [(50, None, 1), (51, [1.0] * 7 + [None], 1), (52, [nan] * 8, 1), (53, [inf] * 8, 2), (54, [1.0] * 9, 2), (None, good[3], 2), (3, good[3], 2), (55, [1e30] * 8, 3)]
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], "vec_id long, embedding array<double>, label int, code string, trees string, error string")
    found = codes.compress(df)
    summed = codes.with_sums(found.found, "label", found.error, "total").collect()
    assert len(summed) == 23 and {r["code"] for r in summed} == {"a"}
    assert len({bytes(r[found.code]) for r in summed if r["vec_id"] in (3, None)}) == 1
    for label in (None, 1, 2, 3):
        mine = [r for r in summed if r["label"] == label]
        assert {r["total"] for r in mine} == {sum(r[found.error] for r in mine)}
    empty = codes.compress(df.limit(0))
    assert empty.found.count() == 0 and empty.digest == hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_query_equals_sql(spark, sf):
    rel = duck(f"{ROOT}/{sf}").sql(ORACLES["op13_vector_codes"])
    df = QUERIES["op13_vector_codes"](spark, f"{ROOT}/{sf}")
    assert difference(df.columns, [tuple(r) for r in df.collect()], rel.columns, rel.fetchall()) is None
