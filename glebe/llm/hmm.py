"""Hidden Markov language model: Baum-Welch over all training documents, exact scores by the scaled forward recursion.

Tokens are words between ASCII white space, A-Z lower-cased, and one end token per text. Every token of
the training documents has its own emission in every state, and so has one token that stands for all
never seen. A state's emissions are its expected counts plus ``1 / states`` each, over their sum.

The texts are encoded once, in blocks of about ``BLOCK`` tokens, one row a block, in a table bucketed by block that never
moves again. The ``known`` most frequent tokens are numbered by a table that travels to the tasks (for speed only), the
others by their place in the block. The tokens are dealt to shards by their hash; a second table, bucketed by
shard, says for each shard and block which of the shard's tokens stand there, as packed places. A pass
of Baum-Welch sends each block the packed emissions of its tokens, runs the scaled forward-backward recursion over its
whole texts, sends the expected counts back to the shards packed in the same order, sums them there and writes what the
blocks need next; the pass before is deleted. So a pass moves a few bytes per block, token and state, and no text. The
driver gets sums per state. Numbers of blocks, shards and buckets grow with the corpus.

Null and empty texts are one end token. Without training documents every token has probability one.
The recursions are scaled at every ``SCALED``-th token. A text of over ``LONG`` tokens keeps every ``LONG``-th forward value only and computes the others again on the way back.
Repeated rows get equal results up to the order of sums, an empty table an empty result. Other columns
are kept; the new ones avoid their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial
from math import ceil
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glebe.llm import words as wd
from glebe.llm.tables import apart, released, shuffles_dropped, stored
from glebe.session import scratch_path

STATES = 4
PASSES = 5
BLOCK = 2_000_000
LONG = 1 << 16
SCALED = 8
BYTES = 5  # of a token, for the number of shards only
END = b"\n"  # no word holds white space
_CELLS = 400_000


class Vocabulary(NamedTuple):
    tokens: int  # all training tokens
    types: int

    def base(self, count) -> np.ndarray:
        return np.log10((np.asarray(count) + 1.0) / (self.tokens + self.types + 1.0))


class Model(NamedTuple):
    first: np.ndarray  # start of a text
    move: np.ndarray
    emit: np.ndarray  # (tokens, states), last the unseen token; a learned model has only that


class Learned(NamedTuple):
    model: Model
    total: np.ndarray  # of each state's weights
    emissions: DataFrame  # block, shard and packed weights of the shard's tokens in the block


class Numbers(dict):
    """Each token's number, the next free one for a new token."""

    def __missing__(self, token: bytes) -> int:
        self[token] = n = len(self)
        return n


def packed(ids: np.ndarray) -> bytes:
    """Two bytes for most numbers, four more for those beyond."""
    return ids.size.to_bytes(8, "little") + np.minimum(ids, 0xFFFF).astype("<u2").tobytes() + ids[ids >= 0xFFFF].astype("<i4").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    ids = np.frombuffer(data, "<u2", n, 8).astype(np.int64)
    ids[ids == 0xFFFF] = np.frombuffer(data, "<i4", -1, 8 + 2 * n)
    return ids


_BLOCK = "block long, ids binary, lengths binary, training binary, shards binary, sizes binary"
_LISTED = "shard int, tokens binary, n binary"


def _bytes(x: np.ndarray, kind: str) -> bytes:
    return np.asarray(x).astype(kind).tobytes()


def _encode(batches: Iterator[pa.RecordBatch], text: str, flag: str, shards: int) -> Iterator[pa.RecordBatch]:
    """A row per block with its texts' tokens as numbers, and one per block and shard with the shard's tokens in it."""
    task, nth = TaskContext.get().partitionId(), 0
    number = Numbers()
    ids: list[np.ndarray] = []
    held, rows = 0, []

    def closed() -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        local = list(number)
        shard = np.array([crc32(t) % shards for t in local], np.int64)
        order = np.argsort(shard, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(order.size)
        flat = place[np.concatenate(ids)]
        length = np.array([x.size for x in ids])
        training = np.array(table.column(flag).to_pylist(), bool)
        n = np.bincount(flat[np.repeat(training, length)], minlength=place.size)
        here, begin = np.unique(shard[order], return_index=True)
        size = np.diff(np.append(begin, order.size))
        names = [c for c in table.schema.names if c not in (text, flag)]
        columns = [table.column(c).combine_chunks() for c in names]
        kept = pa.StructArray.from_arrays(columns, names) if names else pa.nulls(table.num_rows, pa.struct([]))
        first = [packed(flat), _bytes(length, "<i4"), _bytes(training, "?"), _bytes(here, "<i4"), _bytes(size, "<i4")]
        cuts = list(zip(begin.tolist(), (begin + size).tolist()))
        tokens_of = [b" ".join(local[i] for i in order[a:b].tolist()) for a, b in cuts]
        n_of = [_bytes(n[a:b], "<i8") for a, b in cuts]
        more = here.size
        lists = pa.concat_arrays([pa.ListArray.from_arrays(pa.array([0, table.num_rows], pa.int32()), kept), pa.nulls(more, pa.list_(kept.type))])
        columns = [pa.array([(task << 32) + nth] * (1 + more)), *(pa.array([x] + [None] * more, pa.binary()) for x in first), lists,
                   pa.array([None, *here.tolist()], pa.int32()), pa.array([None, *tokens_of], pa.binary()), pa.array([None, *n_of], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["block", "ids", "lengths", "training", "shards", "sizes", "rows", "shard", "tokens", "n"])

    for batch in batches:
        for part in wd.blocks(batch, text, 2 << 20):
            for x in part.column(text).cast(pa.large_binary()):
                said = (x.as_py() or b"").lower().split()
                said.append(END)
                ids.append(np.fromiter(map(number.__getitem__, said), np.int32, len(said)))
                held += len(said)
            rows.append(part.drop_columns([text]))
            if held >= BLOCK:
                yield closed()
                number, ids, held, rows, nth = Numbers(), [], 0, [], nth + 1
    if held:
        yield closed()


def bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """``df`` written in the shared folder in buckets of ``key``, so that joins by it do not move it."""
    path, table = scratch_path(df.sparkSession, name), f"{name}_{uuid.uuid4().hex}"
    with shuffles_dropped(df.sparkSession):
        df.write.option("path", path).option("compression", "zstd").bucketBy(buckets, key).saveAsTable(table)
    return df.sparkSession.table(table)


_ROUTED = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("place", pa.binary()), ("n", pa.binary()), ("tokens", pa.int64()), ("types", pa.int64())])


def _route(listed: pa.Table) -> pa.Table:
    """Places of the tokens of each block among the sorted tokens of the shard, and how often training has them; last the shard's sums."""
    lists = [t.as_py().split(b" ") for t in listed.column("tokens")]
    found = pa.array([t for some in lists for t in some], pa.binary()).dictionary_encode()
    rank = np.empty(len(found.dictionary), np.int64)
    rank[pc.sort_indices(found.dictionary).to_numpy()] = np.arange(rank.size)
    place = rank[found.indices.to_numpy(zero_copy_only=False)]
    n = np.bincount(place, np.concatenate([_read(x, "<i8") for x in listed.column("n")]), rank.size).astype(np.int64)
    cuts = np.append(0, np.cumsum([len(some) for some in lists])).tolist()
    here = [place[a:b] for a, b in zip(cuts, cuts[1:])]
    shard = listed.column("shard")[0].as_py()
    columns = [[shard] * (len(here) + 1), [*listed.column("block").to_pylist(), None], [*(_bytes(p, "<i4") for p in here), None],
               [*(_bytes(n[p], "<i8") for p in here), None], [*[None] * len(here), int(n.sum())], [*[None] * len(here), int((n > 0).sum())]]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, _ROUTED)], schema=_ROUTED)


def _read(value: pa.Scalar, kind: str) -> np.ndarray:
    return np.frombuffer(value.as_py(), kind)


def _begin(batches: Iterator[pa.RecordBatch], states: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        w = []
        for shard, x in zip(batch.column("shard").to_pylist(), batch.column("n")):
            n = _read(x, "<i8")[:, None]
            w.append(_bytes(np.where(n > 0, (n + 1.0) * np.where(np.arange(states) == shard % states, 4.0, 1.0), 0.0), "<f4"))
        yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("shard"), pa.array(w, pa.binary())], ["block", "shard", "w"])


def start(routes: DataFrame, states: int) -> tuple[Learned, Vocabulary]:
    """A first guess: unigram emissions, each state preferring its own share of the tokens.

    Shards are dealt so that all tokens of a shard are of one share.
    """
    lean = (F.col("shard") % states).alias("lean")
    sums = routes.filter("block IS NULL").groupBy(lean).agg(F.sum("tokens").alias("n"), F.sum("types").alias("v")).collect()
    total = np.ones(states)
    for r in sums:
        total += r["n"] + r["v"]
        total[r["lean"]] += 3.0 * (r["n"] + r["v"])
    listed = routes.filter("block IS NOT NULL").select("block", "shard", "n")
    emissions = listed.mapInArrow(partial(_begin, states=states), "block long, shard int, w binary")
    move = np.full((states, states), 0.3 / states) + 0.7 * np.eye(states)
    vocab = Vocabulary(sum(r["n"] for r in sums), sum(r["v"] for r in sums))
    return Learned(Model(np.full(states, 1.0 / states), move, np.ones((1, states)) / total), total, emissions), vocab


def expected(flat: np.ndarray, begin: np.ndarray, length: np.ndarray, m: Model):
    """Expected counts (first states, moves, emissions) of some texts in ``flat``, longest first.

    The texts advance together: the t-th tokens of all that have one follow each other.
    """
    steps = int(length[0])
    alive = np.searchsorted(-length, -np.arange(steps), "left")  # texts longer than t
    at = np.append(0, np.cumsum(alive))
    text = np.arange(at[-1]) - np.repeat(at[:-1], alive)
    ids = flat[begin[text] + np.repeat(np.arange(steps), alive)]
    emit = m.emit[ids]
    a, b = np.empty_like(emit), np.ones_like(emit)
    a[: at[1]] = m.first * emit[: at[1]]
    spans = list(zip(at.tolist(), at[1:].tolist()))
    before = [slice(0, 0), *(slice(lo, lo + k) for (lo, _), k in zip(spans, alive[1:].tolist()))]  # the same texts a step before
    for t, (lo, hi) in enumerate(spans):
        now = a[lo:hi]
        if t:
            np.matmul(a[before[t]], m.move, out=now)
            now *= emit[lo:hi]
        if t % SCALED == 0:
            scale = now.sum(axis=1, keepdims=True)
            now /= scale
            emit[lo:hi] /= scale
    # with this last value, forward times backward is the posterior of the states at every step
    last = at[length - 1] + np.arange(length.size)
    b[last] = 1.0 / a[last].sum(axis=1, keepdims=True)
    back, move = np.ascontiguousarray(m.move.T), np.zeros_like(m.move)
    for t in range(steps - 1, 0, -1):
        lo, hi = spans[t]
        after = emit[lo:hi]
        after *= b[lo:hi]
        move += a[before[t]].T @ after
        # texts that end here keep their last value
        np.matmul(after, back, out=b[before[t]])
    a *= b
    emitted = np.stack([np.bincount(ids, a[:, j], m.emit.shape[0]) for j in range(a.shape[1])], axis=1)
    return a[: at[1]].sum(axis=0), m.move * move, emitted


def expected_long(ids: np.ndarray, m: Model, every: int = LONG):
    """The same for one long text; the forward values between every ``every``-th are computed twice instead of kept."""
    s = m.move.shape[0]

    def ahead(part: np.ndarray, before: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        emit = m.emit[part]
        a, scale = np.empty((part.size, s)), np.empty(part.size)
        for t in range(part.size):
            now = (m.first if before is None else before @ m.move) * emit[t]
            scale[t] = now.sum()
            a[t] = before = now / scale[t]
        return a, scale

    kept: list = [None]
    for lo in range(0, ids.size - every, every):
        kept.append(ahead(ids[lo : lo + every], kept[-1])[0][-1])
    b, move, emitted = np.ones(s), np.zeros((s, s)), np.zeros_like(m.emit)
    for k in range(len(kept) - 1, -1, -1):
        part = ids[k * every : (k + 1) * every]
        a, scale = ahead(part, kept[k])
        emit, state = m.emit[part], np.empty_like(a)
        for t in range(part.size - 1, -1, -1):
            after = emit[t] * b / scale[t]
            state[t] = a[t] * b
            before = a[t - 1] if t else kept[k]
            if before is not None:
                move += m.move * np.outer(before, after)
                b = m.move @ after
        for j in range(s):
            emitted[:, j] += np.bincount(part, state[:, j], m.emit.shape[0])
    return state[0], move, emitted


def _joined(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in column if x.is_valid), kind)


def _local(right: pa.Table, m: Model, total: np.ndarray) -> Model:
    """The model with the emissions of a block's tokens; ``right`` comes by shard."""
    weight = _joined(right.column("w"), "<f4").reshape(-1, total.size) / total
    return m._replace(emit=np.where(weight > 0, weight, m.emit[-1]))


_SENT = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("sums", pa.binary())])


def _learn(left: pa.Table, right: pa.Table, spread: int, shared) -> pa.Table:
    """Expected counts of a block: a row per shard, and one for the first states and the moves."""
    m, total = shared.value
    if not left.num_rows:
        return _SENT.empty_table()
    m = _local(right.sort_by("shard"), m, total)
    block = left.column("block")[0].as_py()
    flat = unpacked(left.column("ids")[0].as_py())
    length, training, shards, sizes = (_read(left.column(c)[0], k) for c, k in (("lengths", "<i4"), ("training", "?"), ("shards", "<i4"), ("sizes", "<i4")))
    length = length.astype(np.int64)
    begin = np.cumsum(length) - length
    first, move, emitted = _sum(flat, begin[training], length[training], m)
    cut = np.append(0, np.cumsum(sizes))
    # float32 holds the counts of one block closely enough; they are added up as doubles
    sums = [np.concatenate([first[None], move]), *(emitted[a:b] for a, b in zip(cut, cut[1:]))]
    columns = [pa.array([-1 - block % spread, *shards.tolist()], pa.int32()), pa.array([block] * len(sums)), pa.array([_bytes(x, "<f4") for x in sums], pa.binary())]
    return pa.table(columns, schema=_SENT)


def _sum(flat: np.ndarray, begin: np.ndarray, length: np.ndarray, m: Model):
    """Expected counts of all texts, so many at a time that their arrays stay small."""
    sums = [np.zeros_like(m.first), np.zeros_like(m.move), np.zeros_like(m.emit)]

    def add(found) -> None:
        for all_of, some in zip(sums, found):
            all_of += some

    for i in np.flatnonzero(length > LONG):
        add(expected_long(flat[begin[i] : begin[i] + length[i]], m))
    order = np.argsort(-length, kind="stable")
    order = order[length[order] <= LONG]
    ends = np.append(0, np.cumsum(length[order]))
    at = 0
    while at < order.size:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + _CELLS, "right")) - 1)
        add(expected(flat, begin[order[at:to]], length[order[at:to]], m))
        at = to
    return sums


_GATHERED = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("w", pa.binary()), ("sums", pa.list_(pa.float64()))])


def _gather(routes: pa.Table, counts: pa.Table, states: int) -> pa.Table:
    """New weights of a shard's tokens for each of its blocks, and their sums; first states and moves are only summed."""
    shard = (routes if routes.num_rows else counts).column("shard")[0].as_py()
    if shard < 0:
        sums = np.sum([_read(x, "<f4") for x in counts.column("sums")], axis=0, dtype=float)
        return pa.Table.from_pylist([{"block": None, "shard": shard, "w": None, "sums": sums}], _GATHERED)
    at = {b.as_py(): _read(p, "<i4") for b, p in zip(routes.column("block"), routes.column("place"))}
    n = np.zeros(1 + max((int(p.max()) for p in at.values()), default=-1), np.int64)
    for b, x in zip(routes.column("block"), routes.column("n")):
        n[at[b.as_py()]] = _read(x, "<i8")
    weight = np.zeros((n.size, states))
    for b, x in zip(counts.column("block"), counts.column("sums")):
        weight[at[b.as_py()]] += _read(x, "<f4").reshape(-1, states)
    weight = np.where(n[:, None] > 0, weight + 1.0 / states, 0.0)
    columns = [pa.array([*at, None], pa.int64()), pa.array([shard] * (len(at) + 1), pa.int32()),
               pa.array([*(_bytes(weight[p], "<f4") for p in at.values()), None], pa.binary()),
               pa.array([*[None] * len(at), weight.sum(axis=0)], pa.list_(pa.float64()))]
    return pa.table(columns, schema=_GATHERED)


def learn(blocks: DataFrame, routes: DataFrame, begin: Learned, passes: int = PASSES, spread: int = 1) -> Learned:
    """Baum-Welch on the training texts of the encoded blocks."""
    model, total, emissions = begin
    states = model.move.shape[0]
    spark = blocks.sparkSession
    old = None
    for _ in range(passes):
        shared = spark.sparkContext.broadcast((model, total))

        def job(left: pa.Table, right: pa.Table) -> pa.Table:
            return _learn(left, right, spread, shared)

        def gathered(left: pa.Table, right: pa.Table) -> pa.Table:
            return _gather(left, right, states)

        counts = blocks.groupBy("block").cogroup(emissions.groupBy("block")).applyInArrow(job, "shard int, block long, sums binary")
        new = routes.groupBy("shard").cogroup(counts.groupBy("shard")).applyInArrow(gathered, "block long, shard int, w binary, sums array<double>")
        found = stored(new, "emissions")
        if old is not None:
            released(old)
        old = found
        summed = found.filter("block IS NULL").select((F.col("shard") < 0).alias("fixed"), F.posexplode("sums").alias("i", "x"))
        rows, weights = np.zeros((1 + states, states)), np.zeros(states)
        for r in summed.groupBy("fixed", "i").agg(F.sum("x").alias("x")).collect():
            (rows if r["fixed"] else weights).flat[r["i"]] = r["x"]
        rows += 1e-3
        each = 1.0 / states
        total = weights + each
        model = Model(rows[0] / rows[0].sum(), rows[1:] / rows[1:].sum(axis=1, keepdims=True), np.full((1, states), each) / total)
        emissions = found.filter("block IS NOT NULL").select("block", "shard", "w")
    return Learned(model, total, emissions)


def forward(ids: np.ndarray, begin: np.ndarray, length: np.ndarray, m: Model) -> np.ndarray:
    """log10 likelihood of each sequence of tokens, exact; all sequences advance together."""
    order = np.argsort(-length, kind="stable")
    begin, size = begin[order], length[order]
    logs = np.zeros(size.size)
    a = np.empty((size.size, m.move.shape[0]))
    ends = np.searchsorted(-size, -np.arange(int(size.max(initial=0)) + 1), "left").tolist()
    for t, k in enumerate(ends[:-1]):
        now = (m.first if t == 0 else a[:k] @ m.move) * m.emit[ids[begin[:k] + t]]
        if t % SCALED == 0:
            total = now.sum(axis=1)
            logs[:k] += np.log10(total)
            now /= total[:, None]
        a[:k] = now
        if ends[t + 1] < k:
            logs[ends[t + 1] : k] += np.log10(a[ends[t + 1] : k].sum(axis=1))
    out = np.empty(size.size)
    out[order] = logs
    return out


def _score(left: pa.Table, right: pa.Table, kept: list[str], names: list[str], shared) -> pa.Table:
    m, total, vocab = shared.value
    right = right.sort_by("shard")
    m = _local(right, m, total)
    flat, length = unpacked(left.column("ids")[0].as_py()), _read(left.column("lengths")[0], "<i4").astype(np.int64)
    begin = np.cumsum(length) - length
    count = _joined(right.column("n"), "<i8")[flat]
    known, base = np.add.reduceat((count > 0).astype(np.int64), begin), np.add.reduceat(vocab.base(count), begin)
    rows = left.column("rows")[0].values
    found = [length, known, base, forward(flat, begin, length, m)]
    return pa.table([*(rows.field(c) for c in kept), *(pa.array(x) for x in found)], names=[*kept, *names])


def score(
    docs: DataFrame, training: Column, text: str = "text", states: int = STATES, passes: int = PASSES,
) -> tuple[DataFrame, list[str], Vocabulary, Model]:
    """``docs`` without the text, with tokens, tokens seen in training, unigram score and the model's score.

    ``training`` says which rows to learn from. Returns the names of the four columns and what was learned.
    """
    context = docs.sparkSession.sparkContext
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    many = ceil(size / (BYTES * BLOCK)) + 1
    shards, buckets, spread = states * ceil(many / states), min(20_000, many // 2 + 6), max(1, many // 256)
    flag, = apart(docs, "in_training")
    kept = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema.fields if f.name != text])
    schema = T.StructType([*T.StructType.fromDDL(_BLOCK).fields, T.StructField("rows", T.ArrayType(kept)), *T.StructType.fromDDL(_LISTED).fields])
    job = partial(_encode, text=text, flag=flag, shards=shards)
    flagged = docs.withColumn(flag, F.coalesce(training, F.lit(False)))
    encoded = bucketed(flagged.mapInArrow(job, schema), "encoded", "block", buckets)
    blocks = encoded.filter("ids IS NOT NULL")
    listed = encoded.filter("tokens IS NOT NULL").select("shard", "block", "tokens", "n")
    routed = listed.groupBy("shard").applyInArrow(_route, "shard int, block long, place binary, n binary, tokens long, types long")
    routes = bucketed(routed, "routes", "shard", buckets)
    texts = blocks.select("block", "ids", "lengths", "training", "shards", "sizes")
    begin, vocab = start(routes, states)
    placed = routes.filter("block IS NOT NULL").select("shard", "block", "place", "n")
    learned = learn(texts, placed, begin, passes, spread)
    names = apart(docs, "n_tokens", "n_known", "base_score", "score")
    shared = context.broadcast((learned.model, learned.total, vocab))

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        return _score(left, right, kept.names, names, shared)

    none = F.lit(None)
    packed = learned.emissions.select("block", "shard", "w", none.cast("binary").alias("n")).unionByName(
        placed.select("block", "shard", none.cast("binary").alias("w"), "n")
    )
    kinds = [T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType()]
    out = T.StructType([*kept.fields, *(T.StructField(n, k) for n, k in zip(names, kinds))])
    found = blocks.select("block", "ids", "lengths", "rows").groupBy("block").cogroup(packed.groupBy("block")).applyInArrow(judge, out)
    return found, names, vocab, learned.model
