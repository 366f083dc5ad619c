"""MinHash near-duplicates with BagMinHash signatures over weighted five-word shingles.

A document is the bag of its runs of five words (A-Z lower-cased, split at ASCII white space; a
shorter text is one run). A signature has ``bands * rows`` places. Every shingle owns Poisson
processes on the weight axis, cut into the dyadic intervals [0,1), [1,2), [2,4), ...: a point has a
time, a place of the signature and a weight in its interval, and counts for a document that holds the
shingle more often than that weight. The earliest time per place is the signature, so two places
agree with the probability of the weighted Jaccard similarity. Points come in order of time; a
process is followed only until it is later than the document's latest place.

Classes of near copies are the connected parts of all verified pairs:

1. equal word sequences are one text (grouped by a 128-bit fingerprint, summed before the shuffle);
2. texts meet in the buckets of their bands; in each bucket one pivot, the text with the most
   companions, is compared with all others. The overlap of the two bags is exact;
3. texts of buckets that still hold several parts meet once more, by a prefix join of their bags:
   ordered from the rarest element on, two bags that are similar enough share one of the first
   ``n - ceil(similarity * n) + 1``. Only pairs of different parts are compared, and only those that a
   parity bitmap leaves open: each element flips one of 1024 bits, so two bags differ in at least as
   many elements as their bitmaps in bits. So every similar pair of a bucket is connected, without
   listing the pairs of a group.

Null and empty texts belong to no class but their own. Repeated rows are copies of one text. The class
id is the least document id of the class. Other columns are kept by ``deduplicate``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glebe.llm import words as wd
from glebe.llm.tables import stored

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 25, 5
LONGS = 16  # of a parity bitmap

U64 = np.uint64
_STEP = U64(0x9E3779B97F4A7C15)


def _times(k: int, odd: int) -> np.uint64:
    return U64(k * odd & 0xFFFFFFFFFFFFFFFF)


def _uniform(bits: np.ndarray) -> np.ndarray:
    return ((bits >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53


def bag_minhash(row: np.ndarray, value: np.ndarray, weight: np.ndarray, rows: int, places: int) -> np.ndarray:
    """(rows, places) earliest times; infinite for a row without shingles."""
    first = np.full((rows, places), np.inf)
    flat = first.reshape(-1)
    deepest = int(np.ceil(np.log2(weight.max()))) if weight.size else -1
    for k in range(deepest + 1):
        low = 0.0 if k == 0 else 2.0 ** (k - 1)
        width = 1.0 if k == 0 else low
        mine = np.flatnonzero(weight > low)
        at, top = row[mine], weight[mine].astype(np.float64)
        seed = wd.mix(value[mine] + _times(k, 0xD6E8FEB86659FD93))
        time = np.zeros(mine.size)
        turn = 0
        while at.size:
            turn += 1
            a = wd.mix(seed + _times(2 * turn, int(_STEP)))
            b = wd.mix(seed + _times(2 * turn + 1, int(_STEP)))
            time = time - np.log(_uniform(a)) / width
            place = ((b >> U64(32)) % U64(places)).astype(np.int64)
            counts = slice(None) if k == 0 else low + width * ((b & U64(0xFFFFFFFF)).astype(np.float64) + 0.5) * 2.0**-32 < top
            np.minimum.at(flat, (at * places + place)[counts], time[counts])
            here, back = np.unique(at, return_inverse=True)
            going = time < first[here].max(axis=1)[back]
            at, top, seed, time = at[going], top[going], seed[going], time[going]
    return first


def _fingerprint(w: wd.Words, rows: int) -> np.ndarray:
    """128 bits of each row's word sequence."""
    counts = np.bincount(w.row, minlength=rows)
    begin = np.cumsum(counts) - counts
    place = (np.arange(w.hash.size) - begin[w.row]).astype(U64)
    out = np.zeros((rows, 2), U64)
    some = np.flatnonzero(counts)
    if some.size:
        for k in (0, 1):
            v = wd.mix(w.hash + wd.mix(place + _times(k, 0xA0761D6478BD642F)))
            out[some, k] = wd.mix(np.add.reduceat(v, begin[some]) + counts[some].astype(U64))
    return out


def _sign(batches: Iterator[pa.RecordBatch], text: str, bands: int, width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in wd.blocks(batch, text):
            rows = part.num_rows
            w = wd.words(part.column(text), wd.SPACED)
            first = bag_minhash(*wd.occurrences(*wd.shingles(w, rows, SHINGLE)), rows, bands * width)
            bits = first.view(U64).reshape(rows, bands, width)
            key = np.broadcast_to(np.arange(bands, dtype=U64), (rows, bands)).copy()
            for k in range(width):
                key = wd.mix(key * _STEP + bits[:, :, k])
            empty = np.isinf(first[:, 0])
            prints = _fingerprint(w, rows)
            whole = [None if e else p.tobytes() for e, p in zip(empty, prints)]
            keys = pa.FixedSizeListArray.from_arrays(pa.array(key.reshape(-1).view(np.int64)), bands).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(whole, pa.binary()), keys], [*part.schema.names, "print", "bands"]
            )


def _bag(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """The bag of each text as distinct numbers: the n-th occurrence of a shingle is its own element."""
    for batch in batches:
        for part in wd.blocks(batch, text):
            rows = part.num_rows
            row, value, n = wd.occurrences(*wd.shingles(wd.words(part.column(text), wd.SPACED), rows, SHINGLE))
            nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            element = wd.mix(np.repeat(value, n) + nth.astype(U64) * _STEP).view(np.int64)
            size = np.bincount(np.repeat(row, n), minlength=rows)
            ends = pa.array(np.append(0, np.cumsum(size)), pa.int32())
            bits = 64 * LONGS
            odd = np.bincount(np.repeat(row, n) * bits + (element.view(U64) % U64(bits)).astype(np.int64), minlength=rows * bits) & 1
            parity = np.packbits(odd.astype(np.uint8)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column("print"), pa.ListArray.from_arrays(ends, pa.array(element)),
                 pa.FixedSizeListArray.from_arrays(pa.array(parity), LONGS).cast(pa.list_(pa.int64()))],
                ["print", "bag", "parity"],
            )


def components(edges: DataFrame) -> DataFrame:
    """(node, part) of an edge table (a, b): the least node reachable.

    Least labels spread over the edges and along labels of labels until nothing changes.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("part")).withColumnRenamed("a", "node")
    while True:
        labels = stored(labels, "labels")
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("part").alias("near"))
        reached = labels.join(near, "node").select("node", F.col("part").alias("old"), F.least("part", "near").alias("part"))
        above = labels.select(F.col("node").alias("part"), F.col("part").alias("up"))
        new = stored(reached.join(above, "part").select("node", "old", F.col("up").alias("part")), "labels")
        if new.filter(F.col("old") != F.col("part")).isEmpty():
            return new.select("node", "part")
        labels = new.select("node", "part")


class NearCopies:
    """The classes of near copies in ``docs``."""

    def __init__(
        self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
        similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, carried: Sequence[str] = (),
    ):
        self.similarity = similarity
        narrow = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), *carried)
        added = [T.StructField("print", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))]
        signed = narrow.mapInArrow(
            partial(_sign, text="text", bands=bands, width=rows), T.StructType([*narrow.schema.fields, *added])
        )
        self.texts = stored(signed, "signed")
        self.edges = self._edges()

    def _edges(self) -> DataFrame:
        """Verified pairs of different texts that connect every class."""
        texts = self.texts.filter("print IS NOT NULL")
        key = ["band", "bucket"]
        bands = texts.groupBy("print").agg(F.first("bands").alias("bands"))
        met = bands.select("print", F.posexplode("bands").alias(*key))
        sizes = met.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")
        members = stored(met.join(sizes, key), "members")
        fame = members.groupBy("print").agg(F.sum("n").alias("fame"))
        bags = stored(
            texts.join(fame, "print", "left_semi").groupBy("print").agg(F.first("text").alias("text"))
            .mapInArrow(partial(_bag, text="text"), "print binary, bag array<bigint>, parity array<bigint>"), "bags",
        )
        pivot = members.join(fame, "print").groupBy(*key).agg(F.max(F.struct("fame", "print")).alias("pivot"))
        stars = members.join(pivot, key).filter("print <> pivot.print")
        linked = stored(self._similar(self._ordered(stars, "print", "pivot.print"), bags), "linked")
        parts = components(linked).withColumnRenamed("node", "print")
        placed = members.join(parts, "print", "left").withColumn("part", F.coalesce("part", "print"))
        several = placed.groupBy(*key).agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p <> q")
        mixed = stored(placed.join(several, key, "left_semi").select("print", "part").distinct(), "mixed")
        return linked.union(stored(self._similar(self._across(mixed, bags), bags), "linked"))

    def _ordered(self, pairs: DataFrame, x: str, y: str) -> DataFrame:
        return pairs.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()

    def _across(self, texts: DataFrame, bags: DataFrame) -> DataFrame:
        """Pairs of texts (print, part) in different parts that share a prefix element."""
        elements = bags.join(texts, "print").select("print", "part", F.explode("bag").alias("e"))
        often = elements.groupBy("e").agg(F.count("*").alias("n"))
        listed = elements.join(often, "e").groupBy("print", "part").agg(F.sort_array(F.collect_list(F.struct("n", "e"))).alias("bag"))
        length = F.size("bag") - F.ceil(F.size("bag") * self.similarity - 1e-9).cast("int") + 1
        prefix = listed.select("print", "part", F.explode(F.slice("bag", F.lit(1), length)).alias("z")).filter("z.n > 1")
        prefix = stored(prefix.select("print", "part", F.col("z.e").alias("e")), "prefix")
        sketch = bags.select("print", F.size("bag").alias("size"), "parity")
        share = prefix.groupBy("e", "part").agg(F.count("*").alias("n"))
        main = share.groupBy("e").agg(F.max_by("part", F.struct("n", "part")).alias("main"), F.count("*").alias("parts")).filter("parts > 1")
        there = prefix.join(main, "e").join(sketch, "print")
        aside = there.filter("part <> main").select(
            "e", F.col("print").alias("other"), F.col("part").alias("part_2"), F.col("size").alias("size_2"), F.col("parity").alias("parity_2")
        )
        differ = reduce(
            lambda x, y: x + y, [F.bit_count(F.get("parity", F.lit(i)).bitwiseXOR(F.get("parity_2", F.lit(i)))) for i in range(LONGS)]
        )
        # of bags with n elements together, d of them in one only, the similarity is (n - d) / (n + d)
        most = (1 - self.similarity) / (1 + self.similarity)
        pairs = there.join(aside, "e").filter(
            F.expr("part <> part_2 AND (part = main OR part < part_2)") & (differ <= most * (F.col("size") + F.col("size_2")) + 1e-6)
        )
        return self._ordered(pairs, "print", "other")

    def _similar(self, pairs: DataFrame, bags: DataFrame) -> DataFrame:
        """The pairs (a, b) whose whole bags have the weighted Jaccard similarity."""
        left = bags.select(F.col("print").alias("a"), F.col("bag").alias("left"))
        right = bags.select(F.col("print").alias("b"), F.col("bag").alias("right"))
        shared = F.size(F.array_intersect("left", "right"))
        alike = shared >= self.similarity * (F.size("left") + F.size("right") - shared) - 1e-9
        return pairs.join(left, "a").join(right, "b").filter(alike).select("a", "b")

    def classes(self) -> DataFrame:
        """(id, class): every document with the least id of its class."""
        texts = self.texts
        part = components(self.edges)
        ids = texts.filter("print IS NOT NULL").groupBy("print").agg(F.min("id").alias("least"))
        named = ids.join(part.withColumnRenamed("node", "print"), "print", "left").withColumn("part", F.coalesce("part", "print"))
        least = named.groupBy("part").agg(F.min("least").alias("class"))
        by_text = named.join(least, "part").select("print", "class")
        return texts.select("id", "print").join(by_text, "print", "left").select("id", F.coalesce("class", "id").alias("class"))


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class: its first by document id, and of equal ids one.

    Rows without words all stay.
    """
    # the whole rows are written once, with their signatures: every later reading sees the same key on the same row
    row = F.struct(F.col(doc_id).alias("own"), F.monotonically_increasing_id().alias("key"))
    rest = F.struct(*[F.col(c) for c in docs.columns if c != text])
    keyed = docs.select(row.alias("id"), F.col(text).alias("text"), rest.alias("rest"))
    found = NearCopies(keyed, "id", "text", carried=["rest"], **options)
    kept = found.classes().filter("id = class").select(F.col("id.key").alias("key"))
    rows = found.texts.select("id.key", "text", "rest").join(kept, "key", "left_semi")
    return rows.select(*[F.col("text").alias(c) if c == text else F.col("rest")[c].alias(c) for c in docs.columns])
