"""Areas and lengths of groups, against a count of unit squares and of unit stretches."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from glebe.functions import geometry as g
from glebe.functions import wkt
from glebe.operators import ground


def boxes(spark, rows):
    df = spark.createDataFrame(rows, "k string, a double, b double, c double, d double")
    return df.select("k", g.rectangle(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("geom"))


def streets(spark, rows):
    df = spark.createDataFrame(rows, "k string, a double, b double, c double, d double")
    return df.select("k", g.segment(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("geom"))


def sizes(df):
    return {r["k"]: r["inter"] for r in df.collect()}


def random_boxes(n, key, seed):
    rng = random.Random(seed)
    for _ in range(n):
        x, y = rng.randrange(60), rng.randrange(60)
        yield key, float(x), float(y), float(x + rng.randint(1, 9)), float(y + rng.randint(1, 9))


def squares(rows):
    out = {}
    for k, a, b, c, d in rows:
        out.setdefault(k, set()).update((x, y) for x in range(int(a), int(c)) for y in range(int(b), int(d)))
    return {k: float(len(v)) for k, v in out.items()}


def test_area_equals_the_squares_covered(spark):
    # one group holds most rows, one has no name, one a single box and its copies
    rows = [*random_boxes(60, "hot", 1), *random_boxes(12, None, 2), *[("copies", 0.0, 0.0, 3.0, 2.0)] * 50]
    found = sizes(ground.united_size(boxes(spark, rows), ["k"], most=16))
    assert found == pytest.approx(squares(rows))


def test_a_crowded_group_is_cut(spark, monkeypatch):
    rows = list(random_boxes(50, "hot", 3))
    widest, united = [], ground._united

    def watched(df, by, size):
        widest.append(df.groupBy(*by).count().agg(F.max("count")).first()[0] or 0)
        return united(df, by, size)

    monkeypatch.setattr(ground, "_united", watched)
    found = sizes(ground.united_size(boxes(spark, rows), ["k"], most=8))
    assert found == pytest.approx(squares(rows))
    assert len(widest) == 2 and 1 < max(widest) <= 8


def test_slanted_pieces_do_not_depend_on_the_cells(spark):
    rng = random.Random(4)
    texts = []
    for _ in range(20):
        x, y = rng.uniform(0, 40), rng.uniform(0, 40)
        p = [(x, y), (x + rng.uniform(5, 15), y + rng.uniform(0, 4)), (x + rng.uniform(0, 9), y + rng.uniform(6, 15))]
        texts.append(("t", "POLYGON((" + ",".join(f"{a} {b}" for a, b in [*p, p[0]]) + "))"))
    layer = spark.createDataFrame(texts, "k string, t string").select("k", wkt.parse("t", 2154).alias("geom"))
    whole = sizes(ground.united_size(layer, ["k"], most=1000))["t"]
    assert sizes(ground.united_size(layer, ["k"], most=9))["t"] == pytest.approx(whole, abs=1e-3)


def test_length_equals_the_stretches_covered(spark):
    rng = random.Random(5)
    rows, stretches = [], set()
    # along lines of the quadtree too: a stretch on a border counts once
    for _ in range(50):
        at, start, n = float(rng.choice([0, 8, 16, 5])), rng.randrange(30), rng.randint(1, 6)
        up = rng.random() < 0.5
        rows.append(("s", at, float(start), at, float(start + n)) if up else ("s", float(start), at, float(start + n), at))
        stretches.update((up, at, start + i) for i in range(n))
    found = sizes(ground.united_size(streets(spark, rows), ["k"], "length", most=8))
    assert found == pytest.approx({"s": float(len(stretches))})


def test_odd_groups(spark):
    layer = boxes(spark, [("a", 0.0, 0.0, 1.0, 1.0), ("a", 5.0, 5.0, 5.0, 9.0), ("flat", 2.0, 2.0, 2.0, 2.0)])
    layer = layer.unionByName(spark.range(1).select(F.lit("null").alias("k"), F.lit(None).cast(g.GEOMETRY).alias("geom")))
    assert sizes(ground.united_size(layer, ["k"])) == {"a": 1.0, "flat": 0.0, "null": 0.0}
    assert ground.united_size(layer.limit(0), ["k"]).count() == 0
    with pytest.raises(ValueError):
        ground.united_size(layer.withColumnRenamed("k", "_n"), ["_n"])
