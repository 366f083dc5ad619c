from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from glebe.functions import geometry as g
from glebe.functions import measure as m
from glebe.functions import overlay as o
from glebe.operators import layers

L_SHAPE = "POLYGON ((0 0, 10 0, 10 4, 4 4, 4 10, 0 10, 0 0))"
HOLED = "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (3 3, 6 3, 6 6, 3 6, 3 3))"
BOW_TIE = "POLYGON ((0 0, 10 10, 0 10, 10 0, 0 0))"


def shapes(spark, *texts, srid=2154):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, wkt string")
    return layers.layer_from_wkt(df, "wkt", srid)


def values(df, *cols):
    return [tuple(r) for r in df.orderBy("id").select(*cols).collect()]


def test_kinds_and_measures_from_text(spark):
    df = shapes(
        spark, L_SHAPE, HOLED, BOW_TIE, "LINESTRING (0 0, 3 4, 3 10)", "POINT (2 5)", "MULTIPOINT ((1 2), (3 4))",
        "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 1, 0 0)), ((5 5, 7 5, 7 7, 5 7, 5 5)))", "LINEARRING (0 0, 4 0, 4 3, 0 0)",
        "MULTILINESTRING ((0 0, 1 0), (5 5, 5 7))", None, "nonsense",
    )
    got = values(df, o.kind_name("geom"), F.round(m.area("geom"), 6), F.round(m.length("geom"), 6), F.round(m.perimeter("geom"), 6))
    assert got == [
        ("Polygon", 64.0, 0.0, 40.0),
        ("Polygon", 91.0, 0.0, 52.0),
        ("MultiPolygon", 50.0, 0.0, round(20 + 2 * math.hypot(10, 10), 6)),
        ("LineString", 0.0, 11.0, 0.0),
        ("Point", 0.0, 0.0, 0.0),
        ("MultiPoint", 0.0, 0.0, 0.0),
        ("MultiPolygon", 5.0, 0.0, 12.0),
        ("LineString", 0.0, 12.0, 0.0),
        ("MultiLineString", 0.0, 3.0, 0.0),
        (None, None, None, None),
        (None, None, None, None),
    ]


def _random_polygon(r: random.Random) -> str:
    angles = sorted(r.uniform(0, 2 * math.pi) for _ in range(7))
    cx, cy = r.uniform(0, 20), r.uniform(0, 20)
    pts = [(cx + r.uniform(3, 12) * math.cos(a), cy + r.uniform(3, 12) * math.sin(a)) for a in angles]
    return "POLYGON ((" + ", ".join(f"{x} {y}" for x, y in [*pts, pts[0]]) + "))"


@pytest.fixture(scope="module")
def pairs(spark):
    r = random.Random(4)
    rows = [(i, _random_polygon(r), _random_polygon(r)) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, wa string, wb string")
    df = layers.layer_from_wkt(layers.layer_from_wkt(df, "wa", 2154, "geom_a"), "wb", 2154, "geom_b")
    df = layers.overlay_union(layers.overlay_intersection(df, out="i"), out="u")
    return df.withColumn("d", o.difference("geom_a", "geom_b")).persist()


def test_overlay_areas_add_up(pairs):
    found = values(pairs, m.area("geom_a"), m.area("geom_b"), m.area("i"), m.area("d"), m.area("u"), o.intersects("geom_a", "geom_b"))
    assert any(i > 0 for _, _, i, *_ in found) and any(i == 0 for _, _, i, *_ in found)
    for a, b, i, d, u, meets in found:
        assert i + d == pytest.approx(a, abs=1e-4)
        assert u == pytest.approx(a + b - i, abs=1e-4)
        assert meets == (i > 0)


def test_cells_tile_the_area(spark, pairs):
    """The pieces of a polygon in the squares of a grid add up to the polygon."""
    from glebe.operators.joins import spatial_join

    grid = spark.range(20 * 20).select(
        F.col("id").alias("cell"),
        g.rectangle((F.col("id") % 20) * 3 - 15, F.floor(F.col("id") / 20) * 3 - 15, (F.col("id") % 20) * 3 - 12, F.floor(F.col("id") / 20) * 3 - 12).alias("geom"),
    )
    layer = pairs.select("id", F.col("geom_a").alias("geom"))
    for tile in (2.0, 50.0):
        met = layers.overlay_intersection(spatial_join(layer, grid, "intersects", tile))
        sums = met.groupBy("id").agg(F.sum(m.area("geom")).alias("s"))
        for s, a in layer.join(sums, "id").select("s", m.area("geom")).collect():
            assert s == pytest.approx(a, abs=1e-4)


def test_closed_and_open_predicates(spark):
    box = "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0))"
    others = [box, "POLYGON ((10 0, 20 0, 20 10, 10 10, 10 0))", "POLYGON ((2 2, 4 2, 4 4, 2 2))", "POLYGON ((8 8, 14 8, 11 14, 8 8))",
              "POLYGON ((30 0, 40 0, 40 9, 30 0))", "POINT (10 10)"]
    df = spark.createDataFrame([(i, box, w) for i, w in enumerate(others)], "id int, wa string, wb string")
    df = layers.layer_from_wkt(layers.layer_from_wkt(df, "wa", 2154, "geom_a"), "wb", 2154, "geom_b")
    got = values(df, o.intersects("geom_a", "geom_b"), o.contains("geom_a", "geom_b"))
    assert got == [(True, True), (True, False), (True, True), (True, False), (False, False), (True, True)]
    assert [r[0] for r in values(df.filter("id < 5"), o.overlaps("geom_a", "geom_b"))] == [False, False, False, True, False]


def test_erode_fill_and_explode(spark):
    df = shapes(spark, L_SHAPE, HOLED, BOW_TIE)
    e = df.withColumn("e", o.erode("geom", 0.5)).withColumn("f", o.fill_holes("geom"))
    got = values(e, F.round(m.area("e"), 6), F.round(m.area("f"), 6), F.size(o.polygons_of("geom")))
    assert got[0] == (64 - 20 + 4 * 0.25, 64.0, 1)
    assert got[1] == (91 - 26, 100.0, 1)
    assert got[2][1:] == (None, 2)  # two triangles meeting in a point


def test_dissolve_does_not_depend_on_buckets_or_copies(spark):
    rows = [(k % 2, float(k * 3), 0.0, float(k * 3 + 5), 4.0) for k in range(12)] * 5
    df = spark.createDataFrame(rows, "k int, a double, b double, c double, d double").select(
        "k", g.rectangle(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("geom")
    )
    for buckets in (1, 3, 64):
        out = layers.dissolve(df, ["k"], buckets=buckets)
        assert sorted((r[0], round(r[1], 6)) for r in out.select("k", m.area("geom")).collect()) == [(0, 120.0), (1, 120.0)]


def test_reproject_known_point_and_errors(spark):
    df = spark.createDataFrame([(0, 3.0, 46.5), (1, 2.35, 48.85)], "id int, x double, y double")
    layer = layers.reproject(layers.layer_from_xy(df, "x", "y", 4326), 2154)
    (x0, y0), (x1, y1) = values(layer, "geom.xmin", "geom.ymin")
    assert (round(x0, 3), round(y0, 3)) == (700000.0, 6600000.0)
    assert 652000 < x1 < 653000 and 6861000 < y1 < 6862000
    with pytest.raises(ValueError):
        layers.reproject(layer, 3857)
    assert values(layers.reproject(layer, 2154), "geom.xmin") == [(x0,), (x1,)]


def _plain(parts):
    return [[(p.x, p.y) for p in ring] for ring in parts]


def test_upright_parts_are_cut_by_the_boxes_near_them(spark):
    """F1 F2: random rectangles, cut and united, against unit squares; a part that nothing meets keeps its ring."""
    random.seed(4)

    def ring(x0, y0, x1, y1, turn=0):
        corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
        return [tuple(map(float, p)) for p in corners[turn:] + corners[:turn]]

    def box():
        x, y = random.randrange(12), random.randrange(12)
        return x, y, x + random.randrange(1, 7), y + random.randrange(1, 7)

    def squares(boxes):
        return {(x, y) for x0, y0, x1, y1 in boxes for x in range(x0, x1) for y in range(y0, y1)}

    cases = [(i, [box()], [box() for _ in range(i % 9)]) for i in range(60)] + [(60, [(0, 0, 3, 3)], [(3, 0, 5, 5), (20, 20, 21, 22)])]
    rows = [(i, [ring(*b, turn=i % 4) for b in a], [ring(*b, turn=1) for b in others]) for i, a, others in cases]
    df = spark.createDataFrame(rows, "i int, a array<array<struct<x:double,y:double>>>, b array<array<struct<x:double,y:double>>>")
    got = df.select(
        "i", g.parts_minus(F.col("a"), F.col("b")).alias("less"),
        g.union_all(F.transform(F.concat("a", "b"), lambda r: F.array(r))).alias("both"),
        g.parts_minus(F.col("a"), F.lit(None).cast(g.PARTS)).alias("none"),
    ).orderBy("i").collect()

    def covered(parts):
        corners = [(min(x for x, _ in r), min(y for _, y in r), max(x for x, _ in r), max(y for _, y in r)) for r in _plain(parts)]
        whole = [tuple(map(int, c)) for c in corners]
        assert sum((c[2] - c[0]) * (c[3] - c[1]) for c in whole) == len(squares(whole))  # no two overlap
        return squares(whole)

    for row, (_, a, others), (_, rings, _) in zip(got, cases, rows):
        assert covered(row.less) == squares(a) - squares(others)
        assert covered(row.both) == squares(a + others)
        assert row.none is None
        if not squares(a) & squares(others):
            assert _plain(row.less) == rings
