"""Plans that must not grow faster than their input, on rows of their own."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from glebe.functions import geometry as g
from glebe.functions import measure as m
from glebe.functions import overlay as o
from glebe.operators import ground, joins, layers, parcels, raster


def _plan(df) -> str:
    return df._jdf.queryExecution().toString()


def _boxes(spark, rows):
    df = spark.createDataFrame(rows, "fid long, x0 double, y0 double, x1 double, y1 double")
    return df.select("fid", g.rectangle(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")).alias("geom"))


def test_filters_do_not_repeat_a_cut(spark):
    layer = _boxes(spark, [(1, 0.0, 0.0, 10.0, 10.0), (2, 5.0, 5.0, 15.0, 15.0), (3, 8.0, 0.0, 12.0, 7.0)])
    each = joins.mirrored(joins.overlap_pairs(layer)).select("fid", "inter_geom")
    env = parcels.minimal_envelope(layer, each)
    filters = [line for line in env._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in line]
    assert filters and not any("_shapes" in line for line in filters)
    got = {r.fid: r.a for r in env.select("fid", m.area("geom").alias("a")).collect()}
    # 3 meets 1 in 2 x 7 and 2 in 4 x 2, and the two cuts share 2 x 2, which is also in the cut of 1 and 2
    assert got == {1: 100 - 25 - 14 + 4, 2: 100 - 25 - 8 + 4, 3: 28 - 14 - 8 + 4}


def test_upright_rectangles_agree_with_half_planes(spark):
    """The same figures, upright and turned by a right triangle of 3, 4 and 5."""
    rows = [(i, float(i % 7), float(i % 5), float(i % 7 + 2 + i % 3), float(i % 5 + 3 + i % 4)) for i in range(40)]
    df = spark.createDataFrame(rows, "fid long, x0 double, y0 double, x1 double, y1 double")
    c = F.col

    def turned(x, y):
        return g.point(0.6 * x - 0.8 * y, 0.8 * x + 0.6 * y)

    def figure(x0, y0, x1, y1, turn):
        corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
        ring = F.array(*[(turned if turn else g.point)(x, y) for x, y in corners])
        return g.from_parts("polygon", F.lit(2154), F.array(ring))

    got = []
    for turn in (False, True):
        two = df.select(
            "fid",
            figure(c("x0"), c("y0"), c("x1"), c("y1"), turn).alias("a"),
            figure(F.lit(3.0), F.lit(2.0), F.lit(6.0), F.lit(5.0), turn).alias("b"),
        )
        two = two.withColumn("less", o.difference("a", "b")).withColumn("both", o.union("a", "b"))
        two = two.withColumn("thin", o.erode("both", 0.25))
        values = [m.area("less"), m.perimeter("less"), m.area("both"), m.perimeter("both"), m.area("thin"),
                  F.size(g.components(c("both.parts"))).cast("double"), F.size(g.components(c("less.parts"))).cast("double")]
        got.append([list(r) for r in two.orderBy("fid").select(*values).collect()])
    for upright, general in zip(*got):
        assert upright == pytest.approx(general, abs=1e-4)


def test_boundary_within_boxes(spark):
    row = spark.range(1).select(
        g.rectangle(F.lit(0), F.lit(0), F.lit(4), F.lit(4)).alias("p"),
        g.rectangle(F.lit(2), F.lit(4), F.lit(9), F.lit(9)).alias("above"),
        g.rectangle(F.lit(-1), F.lit(-1), F.lit(2), F.lit(5)).alias("left"),
    )
    got = row.select(m.shared_boundary_length("p", "above"), m.shared_boundary_length("p", "left")).first()
    assert list(got) == pytest.approx([2.0, 8.0])


def test_nearest_points_are_not_broadcast(spark):
    cells = spark.range(40).select(
        F.col("id").alias("id_cell"), g.rectangle(200 * F.col("id"), F.lit(0), 200 * F.col("id") + 200, F.lit(200)).alias("geom")
    )
    rows = [(i, dt.date(2020, 1, 1 + i % 2), float((i * 7919) % 8000), float(i % 3 * 90)) for i in range(60)]
    pts = spark.createDataFrame(rows, "point_id long, date_result date, x double, y double")
    near = joins.knn_join(cells, pts.select("point_id", "date_result", g.xy_point(F.col("x"), F.col("y")).alias("geom")), k=3)
    assert "Broadcast" not in _plan(near)
    got = {(r.id_cell, r.date_result, r["rank"]): r.point_id for r in near.collect()}
    for cell in range(40):
        for day in (1, 2):
            of_day = [(((x - 200 * cell - 100) ** 2 + (y - 100) ** 2), i) for i, d, x, y in rows if d.day == day]
            want = [i for _, i in sorted(of_day)[:3]]
            assert [got[cell, dt.date(2020, 1, day), n] for n in (1, 2, 3)] == want


def test_texture_windows_are_not_shuffled_as_rows(spark):
    px = spark.range(70 * 66).select(
        F.lit(1).alias("scene"), F.floor(F.col("id") / 66).alias("row"), (F.col("id") % 66).alias("col"),
        ((F.col("id") * 7919) % 256).cast("double").alias("v"),
    )
    whole = raster.haralick(px, "v", radius=2, offset=(1, 1))
    # a row per pixel and window position would be shuffled otherwise
    assert "FlatMapGroupsInPandas" in _plan(whole)
    got = {(r.row, r.col): (r.energy, r.inertia) for r in whole.select("row", "col", "energy", "inertia").collect()}
    grey = {(i // 66, i % 66): int((i * 7919) % 256 / 255 * 8) if (i * 7919) % 256 < 255 else 7 for i in range(70 * 66)}
    assert len(got) == 70 * 66
    for y, x in ((0, 0), (63, 63), (64, 64), (62, 30), (69, 65), (35, 61)):
        n = {}
        for r in range(y - 2, y + 3):
            for c in range(x - 2, x + 3):
                if (r, c) in grey and (r + 1, c + 1) in grey:
                    for p in ((grey[r, c], grey[r + 1, c + 1]), (grey[r + 1, c + 1], grey[r, c])):
                        n[p] = n.get(p, 0) + 1
        t = sum(n.values())
        assert got[y, x] == pytest.approx((sum(v * v for v in n.values()) / t**2, sum(v * (i - j) ** 2 for (i, j), v in n.items()) / t))


def test_a_filter_on_shared_ground_does_not_repeat_the_cut(spark):
    """the filter was pushed below the member joins, with the cut written out at every mention."""
    layer = _boxes(spark, [(1, 0.0, 0.0, 10.0, 10.0), (2, 5.0, 5.0, 15.0, 15.0), (3, 8.0, 0.0, 12.0, 7.0)])
    for pairs in (joins.overlap_pairs(layer), joins.overlap_pairs_between(layer, layer)):
        large = pairs.filter(m.area("inter_geom") > 10)
        assert len(large._jdf.queryExecution().optimizedPlan().toString()) < 100_000
        keys = pairs.columns[:2]
        got = {tuple(sorted((r[0], r[1]))): r.a for r in large.select(*keys, m.area("inter_geom").alias("a")).collect()}
        assert got == {(1, 2): 25.0, (1, 3): 14.0}


def _written_out(df) -> int:
    return len(df._jdf.queryExecution().optimizedPlan().toString())


def test_a_piece_is_cut_to_its_cell_once(spark):
    """the filter on the size of a cut piece held the whole cut several times."""
    c = F.col
    level = spark.createDataFrame([(1, 0.0, 4.0, 1.0), (1, 2.0, 9.0, 3.0)], "k long, x0 double, x1 double, y double")
    rows = level.select("k", g.segment(c("x0"), c("y"), c("x1"), c("y")).alias("geom"))
    at = rows.select("k", "geom", F.lit(3).alias("_level"), F.lit(0).alias("_cx"), F.lit(0).alias("_cy"))
    cut = ground._clipped(at, m.length)
    once = _written_out(at.withColumn("_cell", g.rectangle(F.lit(0.0), F.lit(0.0), F.lit(8.0), F.lit(8.0))).select(o.intersection("geom", "_cell")))
    assert _written_out(cut) < 2 * once
    assert sorted(r.n for r in cut.select(m.length("geom").alias("n")).collect()) == [4.0, 6.0]


def test_a_union_is_built_once_per_group(spark):
    """F20 F21: every measure on a united group wrote the union out again."""
    boxes = _boxes(spark, [(1, 0.0, 0.0, 10.0, 10.0), (1, 5.0, 5.0, 15.0, 15.0), (2, 8.0, 0.0, 12.0, 7.0)])
    united = layers.dissolve(boxes, ["fid"])
    assert _written_out(united.select("fid", m.area("geom").alias("a")).filter("a > 1")) < 1.2 * _written_out(united)
    assert {r.fid: r.a for r in united.select("fid", m.area("geom").alias("a")).collect()} == {1: 175.0, 2: 28.0}
    sized = ground._united(boxes, ["fid"], m.area)
    assert {r.fid: r._size for r in sized.filter("_size > 1").collect()} == {1: 175.0, 2: 28.0}
    assert _written_out(sized.filter("_size > 1")) < 1.2 * _written_out(sized)


def _shuffled_records(df) -> int:
    """Rows that the shuffles of a query wrote; runs it."""
    df.collect()
    seen, todo, rows = set(), [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name != "ReusedExchangeExec":
            if name == "ShuffleExchangeExec" and node.id() not in seen:
                seen.add(node.id())
                rows += node.metrics().apply("shuffleRecordsWritten").value()
            todo.extend(node.children().apply(i) for i in range(node.children().size()))
    return rows


def _nearest(cells, pts, k):
    return {
        (c, n): p
        for c, x, y in cells
        for n, (_, p) in enumerate(sorted(((px - x) ** 2 + (py - y) ** 2, p) for p, px, py in pts)[:k], 1)
    }


@pytest.mark.parametrize("spread", ["even", "crowded", "few"])
def test_nearest_points_meet_zones_of_cells(spark, spread):
    """F4 F5 F7: a row per cell and tile, then one per cell and point around it, was shuffled."""
    cells = [(i, 100.0 * (i % 20) + 50, 100.0 * (i // 20) + 50) for i in range(400)]
    cells += [(1000, 90050.0, -3950.0)]  # far from all points
    at = {
        "even": [(i, float((i * 7919) % 2000), float((i * 104729 + i // 7) % 2000)) for i in range(600)],
        "crowded": [(i, 730.0 + (i * 7919) % 40, 330.0 + (i * 31) % 37) for i in range(300)] + [(900, 1950.0, 1950.0)],
        "few": [(1, 10.0, 10.0), (2, 1800.0, 900.0)],
    }[spread]
    c = F.col
    shapes = spark.createDataFrame(cells, "id_cell long, x double, y double").select(
        "id_cell", g.rectangle(c("x") - 50, c("y") - 50, c("x") + 50, c("y") + 50).alias("geom")
    )
    pts = spark.createDataFrame(at, "point_id long, x double, y double")
    pts = pts.select("point_id", F.lit(dt.date(2020, 1, 1)).alias("date_result"), g.xy_point(c("x"), c("y")).alias("geom"))
    near = joins.knn_join(shapes, pts, k=4)
    assert {(r.id_cell, r["rank"]): r.point_id for r in near.collect()} == _nearest(cells, at, 4)
    if spread == "even":
        assert _shuffled_records(near) < 15_000
