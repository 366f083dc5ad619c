"""Quadtree covers: pieces tile the feature, joins do not depend on the base tile."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks.indicators import region
from glebe import fixtures as fx
from glebe.functions import geometry as g
from glebe.functions import measure as m
from glebe.functions import wkt
from glebe.operators import cover
from tests.compare import ROOT

SF = f"{ROOT}/sf0.001"


@pytest.fixture(scope="module")
def mask(spark):
    return region(spark, SF).checkpoint()


def test_pieces_grow_with_the_border(mask):
    whole = mask.select(m.area("geom")).first()[0]
    counts = []
    for tile in (200.0, 100.0):
        pieces, levels = cover.covered(mask, tile)
        pieces = pieces.checkpoint()
        assert pieces.agg(F.sum(m.area("geom"))).first()[0] == pytest.approx(whole)
        side = F.lit(tile) * F.pow(F.lit(2.0), F.col("_level"))
        inside = (F.col("geom.xmin") >= F.col("_cx") * side - 1e-6) & (F.col("geom.ymax") <= (F.col("_cy") + 1) * side + 1e-6)
        assert pieces.filter(~inside).count() == 0 and len(levels) > (tile < 200)
        counts.append(pieces.count())
    border = 2 * (3960 + 580) + 2 * (1974 + 300)
    assert counts[0] < 4 * border / 200 and counts[1] < 4 * border / 100


def test_join_does_not_depend_on_the_tile(spark, mask):
    # large on both sides
    bands = spark.createDataFrame([(k, 37.0 * k, -20.0, 37.0 * k + 900.0, 500.0 + k) for k in range(12)], "band int, a double, b double, c double, d double")
    bands = bands.select("band", g.rectangle(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("geom"))
    parcels = fx.parcels_a(spark, SF)
    for other, key in ((bands, "band"), (parcels, "fid")):
        found = [
            {r[key]: round(r["area"], 3) for r in cover.shared_areas(mask, other, "mask", key, tile).collect()} for tile in (200.0, 400.0, 1600.0)
        ]
        assert found[0] == found[1] == found[2] and len(found[0]) > 5


def test_odd_features(spark):
    rows = [(1, "POLYGON((0 0,10 0,10 10,0 10,0 0))"), (2, "POLYGON((10 0,20 0,20 10,10 10,10 0))"), (3, None), (4, "POLYGON((-500 -500,-490 -500,-490 -490,-500 -490,-500 -500))")]
    layer = spark.createDataFrame(rows, "a int, t string").select("a", wkt.parse("t", 2154).alias("geom"))
    other = layer.withColumnRenamed("a", "b")
    got = {(r["a"], r["b"]): r["area"] for r in cover.shared_areas(layer, other, "a", "b", 5.0).collect()}
    assert got == {(1, 1): 100.0, (2, 2): 100.0, (4, 4): 100.0}  # neighbours only touch
    assert cover.cover_join(layer.limit(0), other, 5.0).count() == 0
    with pytest.raises(ValueError):
        cover.cover_join(layer, layer)
