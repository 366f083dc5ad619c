"""Benchmark decontamination: a prefix-filtered set join of item-sized windows with whole documents.

Every item gives windows of ``size`` consecutive words (a shorter item is one window). The words of a
window are ordered by rarity in the corpus. A document run can hold a window only if it holds the
window's prefix: all but the share of words that may differ, counted from the rarest. So only the
rarest ``size - needed + 1`` words of each window are looked up in the documents, each match fixes
where the window would lie (positional bound) and whether it fits the text (length bound), and the
words there are compared one by one. With ``containment=1`` the prefix is one word and the check is
equality of the bytes.

Rarities are counted over all documents. The index of windows goes to the tasks in blocks of at most
``block_words`` words; one scan chains all blocks, so an index of any size is searched whole.

Null and empty texts have no words, no hits and no items; an item without a word gives no window.
Repeated rows each get their own result. Columns of ``documents`` other than the two named are kept,
whatever their names; helper columns avoid them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glebe.llm import words as wd
from glebe.llm.tables import apart

SIZE = 10
BLOCK_WORDS = 2_000_000


def windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """(item, words): every window of every item, once per item."""
    word = F.regexp_extract_all(
        F.translate(F.col(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
        F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0),
    )
    listed = benchmark.select(F.col(item).cast("string").alias("item"), word.alias("w")).filter(F.size("w") > 0)
    at = F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1))))
    return listed.select("item", "w", at.alias("at")).select("item", F.slice("w", F.col("at"), size).alias("words")).distinct()


def _count(batches: Iterator[pa.RecordBatch], vocabulary: np.ndarray) -> Iterator[pa.RecordBatch]:
    total = np.zeros(vocabulary.size, np.int64)
    for batch in batches:
        for part in wd.blocks(batch, batch.schema.names[0]):
            found = wd.words(part.column(0), wd.ALNUM).hash
            at = np.searchsorted(vocabulary, found)
            at[at == vocabulary.size] = 0
            total += np.bincount(at[vocabulary[at] == found], minlength=vocabulary.size)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["word", "n"])


def rarities(docs: DataFrame, text: str, vocabulary: np.ndarray) -> np.ndarray:
    """Occurrences in all documents of each benchmark word (sorted hashes)."""
    total = np.zeros(vocabulary.size, np.int64)
    if vocabulary.size:
        counts = docs.select(text).mapInArrow(partial(_count, vocabulary=vocabulary), "word long, n long")
        for r in counts.groupBy("word").agg(F.sum("n").alias("n")).toLocalIterator():
            total[r["word"]] = r["n"]
    return total


class Index:
    """Prefix words of a block of windows: sorted hashes, and for each the window and its place there."""

    def __init__(self, texts: list[list[str]], items: list[list[str]], hashes: np.ndarray, rarity, needed: float):
        self.items = items
        self.length = np.array([len(t) for t in texts], np.int64)
        self.begin = np.cumsum(self.length) - self.length
        self.hash = hashes
        self.least = np.array([max(1, ceil(needed * n - 1e-9)) for n in self.length], np.int64)
        self.text = [" ".join(t).encode() for t in texts]
        window = np.repeat(np.arange(len(texts)), self.length)
        place = np.arange(hashes.size) - self.begin[window]
        order = np.lexsort((place, hashes, rarity, window))
        rank = np.arange(hashes.size) - self.begin[window]
        kept = order[rank <= (self.length - self.least)[window]]
        kept = kept[np.argsort(hashes[kept], kind="stable")]
        self.key, self.window, self.place = hashes[kept], window[kept], place[kept]


def _pairs(found: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in ``found``, position in sorted ``key``) of all equal values."""
    left = np.searchsorted(key, found, "left")
    n = np.searchsorted(key, found, "right") - left
    at = np.flatnonzero(n)
    n = n[at]
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(at, n), np.repeat(left[at], n) + step


def matches(w: wd.Words, rows: int, index: Index, exact: bool) -> tuple[np.ndarray, np.ndarray]:
    """(first word, window) of every place in the texts that holds enough of a window's words."""
    if not w.hash.size or not index.key.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, k = _pairs(w.hash, index.key)
    window, first = index.window[k], at - index.place[k]
    counts = np.bincount(w.row, minlength=rows)
    begin = np.cumsum(counts) - counts
    row = w.row[at]
    fits = (first >= begin[row]) & (first + index.length[window] <= (begin + counts)[row])
    first, window = first[fits], window[fits]
    if not first.size:
        return first, window
    both = np.unique(np.stack([first, window]), axis=1)
    first, window = both[0], both[1]
    same = np.zeros(first.size, np.int64)
    for i in range(int(index.length.max())):
        inside = i < index.length[window]
        a = w.hash[np.where(inside, first + i, 0)]
        b = index.hash[np.where(inside, index.begin[window] + i, 0)]
        same += inside & (a == b)
    good = same >= index.least[window]
    first, window = first[good], window[good]
    if exact:
        good = np.array([_words(w, a, index.length[x]) == index.text[x] for a, x in zip(first, window)], bool)
        first, window = first[good], window[good]
    return first, window


def _words(w: wd.Words, first: int, n: int) -> bytes:
    return b" ".join(wd.LOWER[w.data[w.start[i] : w.end[i]]].tobytes() for i in range(first, first + n))


def _search(batches: Iterator[pa.RecordBatch], text: str, names: tuple, index, exact: bool) -> Iterator[pa.RecordBatch]:
    n_words, hits, items = names
    index = index.value
    for batch in batches:
        for part in wd.blocks(batch, text):
            w = wd.words(part.column(text), wd.ALNUM)
            rows = part.num_rows
            first, window = matches(w, rows, index, exact)
            counts = np.bincount(w.row, minlength=rows)
            begin = np.cumsum(counts) - counts
            old_hits = part.column(hits).to_pylist()
            old_items = part.column(items).to_pylist()
            row = w.row[first] if first.size else first
            for r in np.unique(row):
                mine = row == r
                covered = [np.arange(a, a + n) - begin[r] for a, n in zip(first[mine], index.length[window[mine]])]
                old_hits[r] = np.union1d(old_hits[r], np.concatenate(covered)).astype(np.int64).tolist()
                old_items[r] = sorted({*old_items[r], *(i for x in window[mine] for i in index.items[x])})
            kept = [part.column(c) for c in part.schema.names if c not in names]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(counts.astype(np.int64)), pa.array(old_hits, pa.list_(pa.int64())),
                 pa.array(old_items, pa.list_(pa.string()))],
                [*(c for c in part.schema.names if c not in names), n_words, hits, items],
            )


def search(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    size: int = SIZE, containment: float = 1.0, block_words: int = BLOCK_WORDS,
) -> tuple[DataFrame, tuple[str, str, str]]:
    """``docs`` with the number of words, the places of the hit words and the items found.

    ``containment`` is the share of a window's words that must stand at their places. Returns the
    names of the three columns, which avoid those of ``docs``. Items are sorted as strings. The
    windows of the benchmark pass through the driver a block at a time on their way to the tasks.
    """
    spark = docs.sparkSession
    names = tuple(apart(docs, "n_words", "hit_words", "items"))
    grouped = windows(benchmark, item, item_text, size).groupBy("words").agg(F.sort_array(F.collect_set("item")).alias("items"))
    blocks: list[tuple[list, list]] = [([], [])]
    held = 0
    for r in grouped.toLocalIterator():
        if blocks[-1][0] and held + len(r["words"]) > block_words:
            blocks.append(([], []))
            held = 0
        blocks[-1][0].append(r["words"])
        blocks[-1][1].append(r["items"])
        held += len(r["words"])
    hashed = [wd.words(pa.array([" ".join(t) for t in texts]), wd.ALNUM).hash for texts, _ in blocks]
    vocabulary = np.unique(np.concatenate(hashed))
    count = rarities(docs, text, vocabulary)
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.LongType()),
                           T.StructField(names[1], T.ArrayType(T.LongType())), T.StructField(names[2], T.ArrayType(T.StringType()))])
    out = docs.withColumns({names[0]: F.lit(0).cast("long"), names[1]: F.array().cast("array<bigint>"), names[2]: F.array().cast("array<string>")})
    for (texts, items), h in zip(blocks, hashed):
        index = Index(texts, items, h, count[np.searchsorted(vocabulary, h)], containment)
        job = partial(_search, text=text, names=names, index=spark.sparkContext.broadcast(index), exact=containment >= 1)
        out = out.mapInArrow(job, schema)
    return out, names


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold a window of an item."""
    out, names = search(docs, benchmark, **options)
    return out.filter(F.size(names[1]) == 0).select(*docs.columns)
