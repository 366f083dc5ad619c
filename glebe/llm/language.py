"""Language ID: multinomial naive Bayes over hashed character n-grams (one to three letters).

Texts are lower-cased, everything but letters becomes one kind of gap. Training counts n-grams of every
training document per language and slot, summed over the partitions; the table has languages times
slots entries whatever the corpus, so the log-probability matrix is broadcast. Scoring adds the
matrix columns of a text's n-grams and the log prior; the largest sum names the language. The score is the
probability of that language with sums divided by the root of the number of n-grams.

Null texts and texts without a letter are ``und`` with score 0. Training rows without text or language
are left out; without any training rows all predictions are ``und``. Ties go to the language that sorts
first. Long texts are read in pieces. Repeated rows get equal results, an empty table an empty result.
Other columns are kept; the new ones avoid their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glebe.llm.tables import apart

SLOTS = 1 << 15
LENGTHS = (1, 2, 3)
PIECE = 1 << 18
GAP = 0x20


@cache
def _letters() -> np.ndarray:
    """Lower-case code point of each letter, the gap for all else."""
    out = np.full(0x110000, GAP, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def slots(text: str) -> Iterator[np.ndarray]:
    """Slots of the n-grams of a text, a piece at a time; single gaps count for nothing."""
    last = max(LENGTHS) - 1
    for at in range(0, len(text), PIECE):
        points = np.frombuffer(text[max(0, at - last) : at + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)
        skip = min(at, last)
        code = _letters()[points].astype(np.uint64)
        out = []
        for n in LENGTHS:
            value = np.zeros(max(0, code.size - n + 1), np.uint64)
            some = np.zeros(value.size, bool)
            for k in range(n):
                value = value * np.uint64(0x100000001B3) + code[k : k + value.size] + np.uint64(1)
                some |= code[k : k + value.size] != GAP
            value, some = value[max(0, skip - n + 1) :], some[max(0, skip - n + 1) :]
            value = value[some] + np.uint64(n)
            value ^= value >> np.uint64(29)
            out.append(((value * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(49)).astype(np.int64) % SLOTS)
        yield np.concatenate(out)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            mine = total.setdefault(lang, np.zeros(SLOTS, np.int64))
            for piece in slots(text.as_py()):
                mine += np.bincount(piece, minlength=SLOTS)
    for lang, counts in total.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * at.size, pa.string()), pa.array(at), pa.array(counts[at])], ["lang", "slot", "n"])


class LanguageModel:
    """Languages and the (slots, languages) matrix of log probabilities, with add-one smoothing."""

    def __init__(self, langs: list[str], counts: np.ndarray, documents: np.ndarray):
        self.langs = langs
        self.prior = np.log(documents / documents.sum()) if langs else np.zeros(0)
        smooth = counts + 1.0
        self.matrix = np.ascontiguousarray((np.log(smooth) - np.log(smooth.sum(axis=1, keepdims=True))).T)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.langs:
            return "und", 0.0
        total, n = np.zeros(len(self.langs)), 0
        for piece in slots(text):
            total += np.bincount(piece, minlength=SLOTS) @ self.matrix if piece.size > SLOTS else self.matrix[piece].sum(axis=0)
            n += piece.size
        if not n:
            return "und", 0.0
        total += self.prior
        best = int(np.argmax(total))
        # the score alone is tempered, as overlapping n-grams are no independent witnesses
        total /= np.sqrt(n)
        return self.langs[best], float(1 / np.exp(total - total[best]).sum())


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Model of all rows with text and language."""
    rows = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).dropna()
    counts = rows.mapInArrow(_count, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    documents = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(documents)
    place = {x: i for i, x in enumerate(langs)}
    matrix = np.zeros((len(langs), SLOTS))
    for r in counts.toLocalIterator():
        matrix[place[r["lang"]], r["slot"]] = r["n"]
    return LanguageModel(langs, matrix, np.array([documents[x] for x in langs], float))


def _predict(batches: Iterator[pa.RecordBatch], text: str, model, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [model.value.predict(t.as_py()) for t in batch.column(text)]
        lang, score = zip(*found) if found else ((), ())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())], [*batch.schema.names, *names]
        )


def predict(docs: DataFrame, model: LanguageModel, text: str = "text") -> tuple[DataFrame, list[str]]:
    """``docs`` with predicted language and its probability; returns the names of the two columns."""
    names = apart(docs, "lang_pred", "score")
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(partial(_predict, text=text, model=shared, names=names), schema), names
