"""Vector code compression: product quantisation in integers, each round driven by anchors-hierarchy metric trees.

Each component x becomes floor(4096 x); a vector is cut into ``PARTS`` equal consecutive parts (of a length that
they do not divide, as equal as can be). A part position's codebook starts as that part of the ``ENTRIES``
smallest ids' vectors; each of ``ROUNDS`` rounds assigns every part to the nearest entry (squared distance, ties to
the lower index) and replaces each entry by its parts' componentwise floor(sum / count); unused entries stay.

The points never move, only the entries do. So the vectors are gathered in blocks of ``BLOCK`` once, and for each
block and part a metric tree is built middle-out: anchors as many as the root of the points take over the points nearer
to them than to their old anchor (points closer to it than half the distance of the two anchors cannot change and are not
looked at); the anchors' balls are merged upwards pair by pair, nearest first, and split downwards in the
same way until a ball has ``LEAF`` points. Every ball keeps the sum and count of its points. A round walks the
trees from their roots; a ball inherits its parent's list of candidate entries, strikes out those that are farther
than another from every point of the ball, and once one is left the ball is wholly owned: its cached sum
and count go to that entry and its points are never looked at. Points of leaves that stay undecided are
compared with the candidates left. Bounds are strict beyond rounding, so ties are always decided by points, exactly.

Only sums and counts by entry leave a round, and the codebooks travel to the tasks: both have a fixed size.

Vectors that are null or hold null or non-finite components are left out, and so are those of another length than the
vector with the smallest id. Components beyond +-2^40 (as integers) count as that; errors beyond a long count as the
largest long. Fewer than ``ENTRIES`` vectors make smaller codebooks. Equal ids are ordered by their vectors, null
ids come last. Repeated rows get equal codes. An empty table gives an empty result. Other columns are
kept; the new ones avoid their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glebe.llm.tables import apart, join_spread, stored

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
BLOCK = 8192
LEAF = 96
LARGEST = float(1 << 40)
EXACT = 1 << 50  # squared distances below it are exact in doubles
LONGEST = (1 << 63) - 1
FAR = np.inf


def cuts(length: int, parts: int) -> list[tuple[int, int]]:
    ends = [length * p // parts for p in range(parts + 1)]
    return list(zip(ends, ends[1:]))


class Tree(NamedTuple):
    """A metric tree; its points are ordered so that each ball holds a run of them."""

    order: np.ndarray  # place of each point in the block
    points: np.ndarray
    centre: np.ndarray  # of each ball; the first is the root
    radius: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    left: np.ndarray  # children, -1 for leaves
    right: np.ndarray
    sums: np.ndarray


_FIELDS = {"order": "i", "points": "l", "centre": "d", "radius": "d", "begin": "i", "end": "i", "left": "i", "right": "i", "sums": "l"}
_KINDS = {"i": (pa.int32(), T.IntegerType()), "l": (pa.int64(), T.LongType()), "d": (pa.float64(), T.DoubleType())}
_TREE = T.ArrayType(T.StructType([T.StructField(n, T.ArrayType(_KINDS[k][1])) for n, k in _FIELDS.items()]))
_TREE_ARROW = pa.list_(pa.struct([(n, pa.list_(_KINDS[k][0])) for n, k in _FIELDS.items()]))


def anchors(points: np.ndarray, mine: np.ndarray, many: int) -> list[np.ndarray]:
    """``mine`` dealt to at most ``many`` anchors, each taking the points nearer to it than to their own."""
    first = points[mine[0]]
    far = np.sqrt(((points[mine] - first) ** 2).sum(axis=1))
    order = np.argsort(-far, kind="stable")
    owned, away = [mine[order]], [far[order]]
    at, top = np.empty((many, points.shape[1])), np.zeros(many)
    at[0], top[0] = first, away[0][0]
    while len(owned) < many:
        n = len(owned)
        widest = int(top[:n].argmax())
        if top[widest] == 0:
            break  # only equal points are left
        new = points[owned[widest][0]]
        half = np.sqrt(((at[:n] - new) ** 2).sum(axis=1)) / 2
        looked, tails = np.flatnonzero(top[:n] > half).tolist(), {}
        for i in looked:  # those farther than half come first
            tails[i] = int(away[i].size - np.searchsorted(away[i][::-1], half[i], "right"))
        some = np.concatenate([owned[i][: tails[i]] for i in looked])
        old = np.concatenate([away[i][: tails[i]] for i in looked])
        here = np.sqrt(((points[some] - new) ** 2).sum(axis=1))
        moves = here < old
        begin = 0
        for i in looked:
            stays = ~moves[begin : begin + tails[i]]
            begin += tails[i]
            if not stays.all():
                owned[i] = np.concatenate([owned[i][: tails[i]][stays], owned[i][tails[i] :]])
                away[i] = np.concatenate([away[i][: tails[i]][stays], away[i][tails[i] :]])
                top[i] = away[i][0]
        mine, far = some[moves], here[moves]
        order = np.argsort(-far, kind="stable")
        owned.append(mine[order])
        away.append(far[order])
        at[n], top[n] = new, away[n][0]
    return owned


def _shape(points: np.ndarray, mine: np.ndarray, leaf: int):
    """Nested pairs of point places: anchors, merged upwards and split downwards."""
    if mine.size <= leaf:
        return mine
    groups = anchors(points, mine, max(2, int(np.sqrt(mine.size))))
    if len(groups) == 1:
        return mine
    nodes = [_shape(points, g, leaf) for g in groups]
    size = np.array([g.size for g in groups], float)
    centre = np.stack([points[g].mean(axis=0) for g in groups])
    radius = np.array([np.sqrt(((points[g] - c) ** 2).sum(axis=1).max()) for g, c in zip(groups, centre)])
    # the radius of the ball around two balls
    apart_by = np.sqrt(((centre[:, None] - centre[None]) ** 2).sum(axis=2))
    wide = (apart_by + radius[:, None] + radius[None]) / 2
    np.fill_diagonal(wide, np.inf)
    for _ in range(len(groups) - 1):
        i, j = sorted(divmod(int(np.argmin(wide)), len(groups)))
        nodes[i] = (nodes[i], nodes[j])
        reach = max(radius[i], radius[j], wide[i, j])
        centre[i] = (centre[i] * size[i] + centre[j] * size[j]) / (size[i] + size[j])
        size[i] += size[j]
        radius[i] = reach
        wide[j, :] = wide[:, j] = np.inf
        there = np.flatnonzero(np.isfinite(wide[i]))
        wide[i, there] = wide[there, i] = (np.sqrt(((centre[there] - centre[i]) ** 2).sum(axis=1)) + radius[there] + reach) / 2
    return nodes[0]


def plant(points: np.ndarray, leaf: int = LEAF) -> Tree:
    """The tree of integer points."""
    shape = _shape(points.astype(float), np.arange(len(points)), leaf)
    order: list[np.ndarray] = []
    begin, end, left, right = [], [], [], []
    at = 0
    waiting: list = [(shape, -1, False)]
    while waiting:  # depth first, so that a ball's points follow each other
        node, parent, second = waiting.pop()
        if isinstance(node, int):
            end[node] = at
            continue
        me = len(begin)
        begin.append(at)
        end.append(at)
        left.append(-1)
        right.append(-1)
        if parent >= 0:
            (right if second else left)[parent] = me
        if isinstance(node, tuple):
            waiting += [(me, -1, False), (node[1], me, True), (node[0], me, False)]
        else:
            order.append(node)
            at += node.size
            end[me] = at
    places = np.concatenate(order)
    points = points[places]
    begin, end = np.array(begin), np.array(end)
    count = (end - begin)[:, None]
    total = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(points, axis=0)])
    sums = total[end] - total[begin]
    centre = sums / count
    radius = np.array([np.sqrt(((points[a:b] - c) ** 2).sum(axis=1).max()) for a, b, c in zip(begin, end, centre)])
    return Tree(places, points, centre, radius, begin, end, np.array(left), np.array(right), sums)


def _exact(points: np.ndarray, entries: np.ndarray) -> bool:
    largest = max(int(np.abs(x).max(initial=0)) for x in (points, entries))
    return 4 * largest * largest * points.shape[1] < EXACT


def _nearest(points: np.ndarray, entries: np.ndarray, open_: np.ndarray) -> np.ndarray:
    """The nearest candidate of each point, exactly; of equally near ones the first."""
    if _exact(points, entries):
        far = (entries.astype(float) ** 2).sum(axis=1) - 2.0 * points.astype(float) @ entries.astype(float).T
        return np.where(open_, far, FAR).argmin(axis=1)
    p, e = points.astype(object), entries.astype(object)
    out = np.empty(len(p), int)
    for i in range(len(p)):
        some = np.flatnonzero(open_[i])
        far = [int(((p[i] - e[k]) ** 2).sum()) for k in some]
        out[i] = some[far.index(min(far))]
    return out


def walk(tree: Tree, entries: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray]:
    """(ball, entry) of the balls that are wholly owned, and point and entry of all points outside them."""
    float_entries = entries.astype(float)
    between = np.sqrt(((float_entries[:, None] - float_entries[None]) ** 2).sum(axis=2))
    largest = max(np.abs(x).max(initial=0.0) for x in (float_entries, tree.centre))
    balls = np.zeros(1, int)
    open_ = np.ones((1, len(entries)), bool)
    whole: list[tuple[int, int]] = []
    loose, lists = [np.zeros(0, int)], [np.zeros((0, len(entries)), bool)]
    while balls.size:
        far = ((tree.centre[balls][:, None] - float_entries[None]) ** 2).sum(axis=2)
        best = np.where(open_, far, FAR).argmin(axis=1)
        at_best = far[np.arange(balls.size), best][:, None]
        # over the ball, the least of how much farther an entry is than the best one
        slack = far - at_best - 2 * tree.radius[balls][:, None] * between[best]
        beaten = slack > 1e-9 * (far + at_best + largest * between[best]) + 1e-6
        open_ = open_ & ~beaten
        owned = open_.sum(axis=1) == 1
        whole += zip(balls[owned].tolist(), best[owned].tolist())
        leaf = ~owned & (tree.left[balls] < 0)
        size = (tree.end - tree.begin)[balls[leaf]]
        inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        loose.append(np.repeat(tree.begin[balls[leaf]], size) + inside)
        lists.append(np.repeat(open_[leaf], size, axis=0))
        deeper = ~owned & ~leaf
        balls, open_ = np.concatenate([tree.left[balls[deeper]], tree.right[balls[deeper]]]), np.tile(open_[deeper], (2, 1))
    at = np.concatenate(loose)
    return whole, at, _nearest(tree.points[at], entries, np.concatenate(lists)) if at.size else at


def tally(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and count of the points of each entry."""
    sums = np.zeros(entries.shape, np.int64)
    counts = np.zeros(len(entries), np.int64)
    whole, at, entry = walk(tree, entries)
    for ball, k in whole:
        sums[k] += tree.sums[ball]
        counts[k] += tree.end[ball] - tree.begin[ball]
    np.add.at(sums, entry, tree.points[at])
    return sums, counts + np.bincount(entry, minlength=len(entries))


def assign(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Entry and squared distance of every point, in the block's order."""
    whole, at, entry = walk(tree, entries)
    code = np.empty(len(tree.points), int)
    code[at] = entry
    for ball, k in whole:
        code[tree.begin[ball] : tree.end[ball]] = k
    apart_by = tree.points - entries[code]
    error = (apart_by**2 if _exact(tree.points, entries) else apart_by.astype(object) ** 2).sum(axis=1)
    back = np.empty_like(code)
    back[tree.order] = np.arange(code.size)
    return code[back], error[back]


def integers(vectors: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(vectors.astype(float) * SCALE), -LARGEST, LARGEST).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], vector: str, name: str, parts: int, size: int) -> Iterator[pa.RecordBatch]:
    """Blocks of rows, without vectors, as one list each, with a tree for every part."""
    kept, held, n = None, [], 0

    def block() -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        flat = table.column(vector).combine_chunks()
        flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
        whole = integers(flat.flatten().to_numpy(zero_copy_only=False))
        whole = whole.reshape(table.num_rows, whole.size // table.num_rows)
        trees = [plant(whole[:, a:b]) for a, b in cuts(whole.shape[1], parts)]
        rows = pa.StructArray.from_arrays([table.column(c).combine_chunks() for c in kept], kept) if kept else pa.nulls(table.num_rows, pa.struct([]))
        ends = pa.array([0, table.num_rows], pa.int32())
        found = pa.array([[{f: np.ravel(getattr(t, f)) for f in _FIELDS} for t in trees]], _TREE_ARROW)
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, rows), found], ["rows", name])

    for batch in batches:
        kept = [c for c in batch.schema.names if c != vector]
        at = 0
        while at < batch.num_rows:
            some = batch.slice(at, size - n)
            held.append(some)
            n, at = n + some.num_rows, at + some.num_rows
            if n == size:
                yield block()
                held, n = [], 0
    if n:
        yield block()


def _trees(column: pa.Array) -> Iterator[list[Tree]]:
    for block in column:
        trees = []
        for t in block.values:
            got = {f: t[f].values.to_numpy(zero_copy_only=False) for f in _FIELDS}
            width = got["points"].size // got["order"].size
            shaped = {f: got[f].reshape(got["order" if f == "points" else "begin"].size, width) for f in ("points", "centre", "sums")}
            trees.append(Tree(**{**got, **shaped}))
        yield trees


def _round(batches: Iterator[pa.RecordBatch], name: str, books) -> Iterator[pa.RecordBatch]:
    """Sums and counts by part and entry, of all blocks of a task."""
    total: dict = {}
    for batch in batches:
        for trees in _trees(batch.column(name)):
            for p, (tree, entries) in enumerate(zip(trees, books.value)):
                for k, (s, c) in enumerate(zip(*tally(tree, entries))):
                    if c:
                        old, n = total.get((p, k), (0, 0))
                        total[p, k] = s.astype(object) + old, n + int(c)
    rows = [{"part": p, "entry": k, "n": n, "sums": [int(x) for x in s]} for (p, k), (s, n) in total.items()]
    kind = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])
    yield pa.RecordBatch.from_pylist(rows, kind)


def _codes(batches: Iterator[pa.RecordBatch], name: str, names: tuple[str, str], books) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, trees in enumerate(_trees(batch.column(name))):
            found = [assign(tree, entries) for tree, entries in zip(trees, books.value)]
            rows = batch.column("rows")[i].values
            code = np.stack([c for c, _ in found], axis=1).astype(np.uint8)
            error = [min(int(sum(e)), LONGEST) for e in zip(*(e.tolist() for _, e in found))]
            columns = [rows.field(f) for f in range(rows.type.num_fields)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([c.tobytes() for c in code], pa.binary()), pa.array(error, pa.int64())],
                [*(f.name for f in rows.type), *names],
            )


class Codes(NamedTuple):
    found: DataFrame  # rows without their vectors, with code (one byte a part) and error
    code: str
    error: str
    books: list[np.ndarray]  # by part, entries by components

    @property
    def digest(self) -> str:
        text = ",".join(str(x) for book in self.books for entry in book.tolist() for x in entry)
        return hashlib.sha256(text.encode()).hexdigest()


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & ~bad


def compress(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
    rounds: int = ROUNDS, block: int = BLOCK,
) -> Codes:
    """Codebooks learned from all usable rows of ``vectors``, and the rows' codes."""
    spark = vectors.sparkSession
    code, error, trees = apart(vectors, "code", "error", "trees")
    good = vectors.filter(usable(F.col(vector)))
    first = good.orderBy(F.col(vec_id).asc_nulls_last(), vector).select(vector).limit(entries).collect()
    length = len(first[0][0]) if first else 0
    start = [r[0] for r in first if len(r[0]) == length]
    good = good.filter(F.size(vector) == length)
    if len(start) < len(first):
        start = [r[0] for r in good.orderBy(F.col(vec_id).asc_nulls_last(), vector).select(vector).limit(entries).collect()]
    whole = integers(np.array(start, float).reshape(len(start), length))
    books = [whole[:, a:b] for a, b in cuts(length, parts)]

    kept = T.StructType([T.StructField(f.name, f.dataType, True) for f in vectors.schema.fields if f.name != vector])
    schema = T.StructType([T.StructField("rows", T.ArrayType(kept)), T.StructField(trees, _TREE)])
    job = partial(_blocks, vector=vector, name=trees, parts=parts, size=block)
    planted = stored(good.withColumn(vector, F.col(vector).cast("array<double>")).mapInArrow(job, schema), "trees")
    for _ in range(rounds if len(start) else 0):
        shared = spark.sparkContext.broadcast(books)
        sums = F.array(*[F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")) for i in range(max(b - a for a, b in cuts(length, parts)))])
        found = planted.select(trees).mapInArrow(partial(_round, name=trees, books=shared), "part int, entry int, n long, sums array<long>")
        books = [b.copy() for b in books]
        for r in found.groupBy("part", "entry").agg(F.sum("n").alias("n"), sums.alias("sums")).collect():
            width = books[r["part"]].shape[1]
            books[r["part"]][r["entry"]] = [int(x) // r["n"] for x in r["sums"][:width]]
    out = T.StructType([*kept.fields, T.StructField(code, T.BinaryType()), T.StructField(error, T.LongType())])
    last = partial(_codes, name=trees, names=(code, error), books=spark.sparkContext.broadcast(books))
    return Codes(planted.mapInArrow(last, out), code, error, books)


def with_sums(found: DataFrame, label: str, value: str, name: str) -> DataFrame:
    """``found`` with the sum of ``value`` over the rows of its label, nulls together; labels may be few or many."""
    key, rows = apart(found, "label_key", "label_rows")
    text = F.col(label).cast("string")
    keyed = stored(found.withColumn(key, F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), text))), "codes")
    sums = stored(keyed.groupBy(key).agg(F.try_sum(value).alias(name), F.count("*").alias(rows)), "labels")
    return join_spread(keyed, sums, key, rows).drop(key)
