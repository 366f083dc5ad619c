"""Licence scans: a trained paragraph classifier, confirmed by comparison with templates; DataFrame operations only.

A paragraph is a line. Its features are the word pairs (A-Z lower-cased words of letters, digits and
dots; a text edge counts as a word) that occur in the labelled templates, so the model is a small
table (pair, weights) whatever the corpus. Multinomial logistic regression over the licence families
and ``unknown`` is fitted on the driver from the templates and at most ``max_negative`` paragraphs of
``sample_rows`` documents, taken in the order of a hash; paragraphs that hold half of a template's pairs
are no negatives. Half of the negatives are held out: the threshold on a family's probability is at
least one half and above what all but ``false_rate`` of them reach, else the paragraph stays unknown. A
prediction counts only if the paragraph holds the share ``confirm`` of the pairs of one of the family's templates, and of those that no other family has.

Notices that are wrapped over lines, or share a line with others, are found by runs: the pairs of a whole
text, across its lines and comment marks, are joined with the pairs inside all templates. A template is
confirmed where one run of at most ``STRETCH`` times its words holds the share ``confirm`` of its pairs and
the same share of those that no other family has. Runs that overlap are one notice, on the line where the one
with most pairs begins; a family that a line of the run has already is not counted again.

All paragraphs of all texts are scanned: pairs are exploded and joined with the model's pairs, and
what matches is summed per text and line. Equal texts share one result. Null and empty texts have no
paragraphs. An empty table gives an empty result. Other columns are kept; the new ones avoid their names.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glebe.llm.tables import apart

MAX_NEGATIVE = 4000
SAMPLE_ROWS = 200
FALSE_RATE = 0.001
CONFIRM = 0.6
STRETCH = 1.25

#: Licence families and usual wordings of their notices
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("gpl-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("bsd-3-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd-3-clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("proprietary", "All rights reserved."),
]
#: Wordings of further families and of choices between two, confirmed by runs
RUNS = [
    ("agpl-3.0", "the terms of the GNU Affero General Public License"),
    ("agpl-3.0", "licensed under the GNU Affero General Public License, version 3"),
    ("agpl-3.0", "SPDX-License-Identifier: AGPL-3.0-or-later"),
    ("lgpl", "the terms of the GNU Lesser General Public License"),
    ("lgpl", "licensed under the GNU Lesser General Public License"),
    ("lgpl", "SPDX-License-Identifier: LGPL-2.1-or-later"),
    ("lgpl", "SPDX-License-Identifier: LGPL-3.0-or-later"),
    ("gpl-2.0", "under the terms of the GNU General Public License version 2"),
    ("gpl-2.0", "GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2"),
    ("gpl-2.0", "SPDX-License-Identifier: GPL-2.0-or-later"),
    ("gpl-3.0", "GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", "SPDX-License-Identifier: ISC"),
    ("cc0-1.0", "Creative Commons CC0 1.0 Universal"),
    ("cc0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("epl-2.0", "SPDX-License-Identifier: EPL-2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("unlicense", "SPDX-License-Identifier: Unlicense"),
    ("bsd-2-clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("mpl-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("mit", "MIT OR Apache-2.0"), ("apache-2.0", "MIT OR Apache-2.0"),
    ("mit", "Apache-2.0 OR MIT"), ("apache-2.0", "Apache-2.0 OR MIT"),
]
_WORD = r"[\p{L}\p{N}]+(?:\.[\p{N}]+)?"
_EDGE = "^"


def words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+(?:\.\d+)?", text.lower())


def pairs(text: str) -> set[str]:
    listed = [_EDGE, *words(text), _EDGE]
    return {f"{a} {b}" for a, b in zip(listed, listed[1:])}


def pair_column(line: Column) -> Column:
    """Distinct word pairs of a line, edges included."""
    edge = F.array(F.lit(_EDGE))
    found = F.regexp_extract_all(F.lower(line), F.lit(_WORD), F.lit(0))
    left, right = F.concat(edge, found), F.concat(found, edge)
    return F.array_distinct(F.zip_with(left, right, lambda a, b: F.concat_ws(" ", a, b)))


class LicenceModel:
    """Weights of the word pairs for each family, last ``unknown``, and the calibrated threshold."""

    def __init__(self, templates: list[tuple[str, str]], negatives: list[str], false_rate: float = FALSE_RATE):
        self.wordings = templates
        self.families = sorted({f for f, _ in templates})
        self.templates = [(self.families.index(f), pairs(t)) for f, t in templates]
        self.pairs = sorted(set().union(*(p for _, p in self.templates)))
        place = {p: i for i, p in enumerate(self.pairs)}
        clear = [pairs(t) for t in negatives]
        clear = [p for p in clear if all(len(p & t) < 0.5 * len(t) for _, t in self.templates)]
        fit, held = clear[::2], clear[1::2]
        rows = [p for _, p in self.templates] * 20 + fit + [set()]
        label = np.array([f for f, _ in self.templates] * 20 + [len(self.families)] * (len(fit) + 1))
        x = self._matrix(rows, place)
        want = np.eye(len(self.families) + 1)[label]
        share = np.bincount(label, minlength=want.shape[1])
        weight = (1.0 / np.maximum(share, 1))[label][:, None] / want.shape[1]
        self.weight, self.bias = np.zeros((len(place), want.shape[1])), np.zeros(want.shape[1])
        for _ in range(300):
            error = (self._softmax(x @ self.weight + self.bias) - want) * weight
            self.weight -= 3.0 * (x.T @ error + 1e-4 * self.weight)
            self.bias -= 3.0 * error.sum(axis=0)
        top = np.sort(self._softmax(self._matrix(held, place) @ self.weight + self.bias)[:, :-1].max(axis=1)) if held else np.zeros(1)
        self.threshold = max(0.5, float(top[max(0, int(np.ceil((1 - false_rate) * top.size)) - 1)]))

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    @staticmethod
    def _matrix(rows: list[set[str]], place: dict[str, int]) -> np.ndarray:
        x = np.zeros((len(rows), len(place)))
        for i, row in enumerate(rows):
            for p in row:
                if p in place:
                    x[i, place[p]] = 1.0
        return x


def train(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: list[tuple[str, str]] = TEMPLATES,
    sample_rows: int = SAMPLE_ROWS, max_negative: int = MAX_NEGATIVE, false_rate: float = FALSE_RATE,
) -> LicenceModel:
    some = docs.select(F.xxhash64(F.col(doc_id).cast("string")).alias("order"), F.col(text).alias("text")).orderBy("order").limit(sample_rows)
    lines = some.select("order", F.posexplode(F.split("text", "\n", -1)).alias("line", "paragraph")).filter(F.rlike("paragraph", F.lit(r"\p{L}")))
    negatives = [r["paragraph"] for r in lines.orderBy(F.xxhash64("paragraph"), "paragraph").limit(max_negative).collect()]
    return LicenceModel(templates, negatives, false_rate)


def _lines(docs: DataFrame, model: LicenceModel, text: str = "text", confirm: float = CONFIRM) -> DataFrame:
    """(print, line, family, score): the lines that alone are confirmed licence paragraphs."""
    spark = docs.sparkSession
    n = len(model.families) + 1
    every = [(f, pairs(t)) for f, t in [*model.wordings, *RUNS]]
    own = [t - set().union(*(p for f, p in every if f != model.families[k])) for k, t in model.templates]
    rows = [
        (p, [float(w) for w in weights], [i for i, (_, t) in enumerate(model.templates) if p in t], [i for i, t in enumerate(own) if p in t])
        for p, weights in zip(model.pairs, model.weight)
    ]
    weights = spark.createDataFrame(rows, "pair string, weights array<double>, templates array<int>, own array<int>")
    lines = docs.select(F.xxhash64(text).alias("print"), F.posexplode(F.split(F.col(text), "\n", -1)).alias("line", "paragraph"))
    listed = lines.select("print", "line", F.explode(pair_column(F.col("paragraph"))).alias("pair"))
    # as few pairs as there are in the templates; equal texts meet before the sums
    hits = listed.join(F.broadcast(weights), "pair").groupBy("print", "line", "pair").agg(
        F.first("weights").alias("weights"), F.first("templates").alias("templates"), F.first("own").alias("own")
    )
    scores = [F.sum(F.get("weights", F.lit(k))).alias(f"z{k}") for k in range(n)]
    shared = [F.sum(F.array_contains("templates", i).cast("int")).alias(f"t{i}") for i in range(len(model.templates))]
    owned = [F.sum(F.array_contains("own", i).cast("int")).alias(f"o{i}") for i in range(len(own))]
    summed = hits.groupBy("print", "line").agg(*scores, *shared, *owned)
    z = F.array(*[F.col(f"z{k}") + float(model.bias[k]) for k in range(n)])
    summed = summed.withColumn("z", z)
    top = F.array_max("z")
    best = (F.array_position("z", top) - 1).cast("int")
    score = 1 / F.aggregate("z", F.lit(0.0), lambda acc, x: acc + F.exp(x - top))
    likeness = F.array(*[
        F.greatest(F.lit(0.0), *[
            F.when(F.col(f"o{i}") >= confirm * len(own[i]), F.col(f"t{i}") / float(len(t))) for i, (f, t) in enumerate(model.templates) if f == k]) for k in range(n - 1)
    ])
    family = F.array(*[F.lit(f) for f in model.families])
    found = summed.select("print", "line", best.alias("best"), score.alias("score"), likeness.alias("likeness"))
    sure = (F.col("best") < n - 1) & (F.col("score") > model.threshold) & (F.get("likeness", F.col("best")) >= confirm)
    return found.filter(sure).select("print", "line", F.get(family, F.col("best")).alias("family"), "score")


def _inner(text: str) -> list[str]:
    listed = words(text)
    return [f"{a} {b}" for a, b in zip(listed, listed[1:])]


def _runs(docs: DataFrame, templates: list[tuple[str, str]], text: str, confirm: float) -> DataFrame:
    """(print, line, last, family, score): the runs of words that confirm a template, line of their best start and last line."""
    listed = [(f, set(_inner(t)), int(STRETCH * len(words(t)))) for f, t in templates]
    rows = []
    for k, (family, mine, width) in enumerate(listed):
        others = set().union(*(p for f, p, _ in listed if f != family))
        need, need_own = (int(np.ceil(confirm * len(x) - 1e-9)) for x in (mine, mine - others))
        rows += [(p, k, i, p not in others, family, width, len(mine), need, need_own) for i, p in enumerate(sorted(mine))]
    known = docs.sparkSession.createDataFrame(
        rows, "pair string, template int, id int, own boolean, family string, width int, size int, need int, need_own int"
    )
    by_line = F.transform(F.split(F.col(text), "\n", -1), lambda line, i: F.transform(
        F.regexp_extract_all(F.lower(line), F.lit(_WORD), F.lit(0)), lambda w: F.struct(w.alias("word"), i.alias("line"))))
    flat = docs.select(F.xxhash64(text).alias("print"), F.flatten(by_line).alias("flat"))
    two = F.zip_with(F.col("flat"), F.slice("flat", 2, F.greatest(F.size("flat"), F.lit(1))), lambda a, b: F.struct(
        F.concat_ws(" ", a["word"], b["word"]).alias("pair"), a["line"].alias("line"), b["line"].alias("last")))
    pairs_at = flat.select("print", F.posexplode(two).alias("pos", "at")).select("print", "pos", "at.*")
    # a text's pairs of a template, only if all of the text has enough of them
    held = (
        pairs_at.join(F.broadcast(known), "pair").groupBy("print", "template", "family", "width", "size", "need", "need_own")
        .agg(F.collect_set(F.struct("pos", "line", "last", "id", "own")).alias("hits"))
        .filter(F.size(F.array_distinct(F.col("hits.id"))) >= F.col("need"))
    )
    hits = held.withColumn("hit", F.explode("hits")).select("*", "hit.*").drop("hits", "hit")
    ahead = Window.partitionBy("print", "template").orderBy("pos").rangeBetween(0, max(w for _, _, w in listed))
    near = F.filter(F.collect_list(F.struct("pos", "id", "own", "last")).over(ahead), lambda x: x["pos"] <= F.col("pos") + F.col("width") - 2)
    runs = hits.withColumn("near", near).select(
        "print", "family", "pos", "line", "width", "size", "need", "need_own", F.array_max("near.last").alias("last"),
        F.size(F.array_distinct(F.col("near.id"))).alias("n"),
        F.size(F.array_distinct(F.transform(F.filter("near", lambda x: x["own"]), lambda x: x["id"]))).alias("n_own"),
    ).filter((F.col("n") >= F.col("need")) & (F.col("n_own") >= F.col("need_own")))
    order = Window.partitionBy("print", "family").orderBy("pos", "width")
    fresh = F.coalesce(F.col("pos") >= F.max(F.col("pos") + F.col("width")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    numbered = runs.withColumn("fresh", fresh.cast("int")).withColumn("nth", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    share = F.col("n") / F.col("size")
    return numbered.groupBy("print", "family", "nth").agg(
        F.max_by("line", F.struct("n", "pos")).alias("line"), F.min("line").alias("begin"), F.max("last").alias("last"), F.max(share).alias("score")
    )


def paragraphs(docs: DataFrame, model: LicenceModel, text: str = "text", confirm: float = CONFIRM) -> DataFrame:
    """(print, line, family, score): the confirmed licence notices of every text, by the text's hash."""
    lines = _lines(docs, model, text, confirm)
    mine = lines.select(F.col("print").alias("p"), F.col("family").alias("f"), F.col("line").alias("l"))
    runs = _runs(docs, [*model.wordings, *RUNS], text, confirm)
    there = (F.col("print") == F.col("p")) & (F.col("family") == F.col("f")) & F.col("l").between(F.col("begin"), F.col("last"))
    return lines.unionByName(runs.join(mine, there, "left_anti").select("print", "line", "family", "score"))


def scan(docs: DataFrame, model: LicenceModel, text: str = "text", confirm: float = CONFIRM) -> tuple[DataFrame, list[str]]:
    """``docs`` with its number of licence paragraphs, their families, lines and best score; returns the names of these columns."""
    names = apart(docs, "n_licences", "families", "lines", "best_score")
    key, = apart(docs, "text_print")
    found = paragraphs(docs, model, text, confirm).groupBy(F.col("print").alias(key)).agg(
        F.count("*").alias(names[0]), F.sort_array(F.collect_set("family")).alias(names[1]), F.sort_array(F.collect_list("line")).alias(names[2]),
        F.max("score").alias(names[3]),
    )
    none = [F.coalesce(names[0], F.lit(0)).cast("long"), F.coalesce(names[1], F.array().cast("array<string>")), F.coalesce(names[2], F.array().cast("array<int>")),
            F.coalesce(names[3], F.lit(0.0))]
    joined = docs.withColumn(key, F.xxhash64(text)).join(found, key, "left")
    return joined.select(*docs.columns, *[c.alias(n) for c, n in zip(none, names)]), names
