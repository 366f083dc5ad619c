"""Publishing, resuming, shifted grids and appends that do not fit."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from glebe.functions import geometry as g
from glebe.operators import joins, raster, stats
from glebe.plans.indicator import IndicatorSpec, build_indicator, publish
from glebe.sources import sinks

SQUARES = [(1, 0.0, 0.0), (2, 100.0, 0.0), (3, 0.0, 100.0), (4, 100.0, 100.0)]


def cells(spark, shift=0.0):
    df = spark.createDataFrame([(i, 1, x + shift, y + shift) for i, x, y in SQUARES], "id_cell bigint, id_grid int, x double, y double")
    return df.select("id_cell", "id_grid", g.rectangle(F.col("x"), F.col("y"), F.col("x") + 100, F.col("y") + 100).alias("geom"))


def parcels(spark):
    rows = [("2001-01-01", 10.0, 10.0), ("2001-01-01", 30.0, 120.0), ("2002-01-01", 5.0, 10.0)]
    df = spark.createDataFrame(rows, "d string, value_num double, x double")
    return df.select(
        F.to_date("d").alias("date_result"), F.lit(7).alias("id_variable"), "value_num", F.lit(None).cast("string").alias("value_str"),
        g.rectangle(F.col("x"), F.lit(10.0), F.col("x") + 20, F.lit(30.0)).alias("geom"),
    )


def points(spark, rows):
    df = spark.createDataFrame(rows, "x double, y double")
    return df.select(
        F.lit("2001-01-01").cast("date").alias("date_result"), F.lit(1.0).alias("value_num"), F.lit("a").alias("value_str"),
        g.xy_point(F.col("x"), F.col("y"), F.lit(2154)).alias("geom"),
    )


def test_a_stricter_condition_removes_the_date_it_empties(spark, tmp_path):
    path, log = str(tmp_path / "results"), str(tmp_path / "log")
    spec = IndicatorSpec(1, 7, 1, "ct_elt")
    publish(build_indicator(cells(spark), parcels(spark), spec), path, log, "me", [1])
    other = IndicatorSpec(2, 7, 1, "ct_elt")
    publish(build_indicator(cells(spark), parcels(spark), other), path, log, "me", [2])
    strict = IndicatorSpec(1, 7, 1, "ct_elt", condition_variable="value_num >= 10")
    publish(build_indicator(cells(spark), parcels(spark), strict), path, log, "me", [1])
    dates = {(r[0], r[1].year) for r in spark.read.parquet(path).select("id_indicator", "date_result").distinct().collect()}
    assert dates == {(1, 2001), (2, 2001), (2, 2002)}


def test_a_second_resume_has_nothing_to_do(spark):
    spec = IndicatorSpec(1, 7, 1, "ct_elt", condition_variable="value_num >= 10")
    done = build_indicator(cells(spark), parcels(spark), spec)
    assert done.count() == 2
    assert build_indicator(cells(spark), parcels(spark), spec, existing=done).count() == 0
    # on the border of cells 1 and 2, and across 3; the line of 2002 only touches cell 1
    rows = [("2001-01-01", 10.0, 150.0, 60.0, 150.0), ("2002-01-01", -20.0, 50.0, 0.0, 50.0)]
    lines = spark.createDataFrame(rows, "d string, x1 double, y1 double, x2 double, y2 double").select(
        F.to_date("d").alias("date_result"), F.lit(7).alias("id_variable"), F.lit(1.0).alias("value_num"), F.lit("a").alias("value_str"),
        g.from_parts("line", F.lit(2154), F.array(F.array(g.point(F.col("x1"), F.col("y1")), g.point(F.col("x2"), F.col("y2"))))).alias("geom"),
    )
    spec = IndicatorSpec(1, 7, 1, "ct_elt")
    done = build_indicator(cells(spark), lines, spec)
    assert [r["id_cell"] for r in done.collect()] == [3]
    assert build_indicator(cells(spark), lines, spec, existing=done).count() == 0


@pytest.mark.parametrize("shift", [0.0, 50.0, -33.5])
def test_points_meet_the_squares_of_a_shifted_grid(spark, shift):
    pts = points(spark, [(10.0 + shift, 10.0 + shift), (100.0 + shift, 100.0 + shift), (130.0 + shift, 60.0 + shift)])
    grid = cells(spark, shift)
    assert joins.lattice_origin(grid, 100.0) == (shift % 100, shift % 100)
    found = {r["id_cell"]: r["value_num"] for r in stats.point_stats(grid, pts, "ct_elt", None, 100.0).collect()}
    assert found == {1: 2.0, 2: 2.0, 3: 1.0, 4: 1.0}
    assert sorted(r[0] for r in joins.points_in_cells(pts, grid, 100.0).select("id_cell").collect()) == [1, 1, 2, 2, 3, 4]


def test_cells_off_the_lattice_go_through_the_tile_join(spark):
    grid = cells(spark).unionByName(cells(spark, 250.0).filter("id_cell = 1").withColumn("id_cell", F.lit(9).cast("bigint")))
    assert joins.lattice_origin(grid, 100.0) is None
    pts = points(spark, [(260.0, 260.0), (10.0, 10.0)])
    found = {r["id_cell"]: r["value_num"] for r in stats.point_stats(grid, pts, "ct_elt", None, 100.0).collect()}
    assert found == {9: 1.0, 1: 1.0}


def test_appended_values_must_fit(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.save_table(spark.createDataFrame([(1, 2.0)], "k int, v double"), path, primary_key=["k"])
    with pytest.raises(Exception, match="does not fit"):
        sinks.save_table(spark.createDataFrame([("2", "x")], "k string, v string"), path, append=True, primary_key=["k"])
    with pytest.raises(ValueError, match="not unique"):
        sinks.save_table(spark.createDataFrame([("1", "3")], "k string, v string"), path, append=True, primary_key=["k"])
    sinks.save_table(spark.createDataFrame([("2", None)], "k string, v string"), path, append=True, primary_key=["k"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, 2.0), (2, None)]


def test_each_scene_is_stretched_by_itself(spark):
    rows = [(s, i, 0, [float(i * scale)]) for s, scale in (("a", 1), ("b", 10)) for i in range(101)]
    px = spark.createDataFrame(rows, "scene string, row int, col int, b array<double>")
    out = raster.dynamic_convert(px, 1, q=0.0).collect()
    assert len(out) == 202 and all(r["b"][0] == pytest.approx(r["row"] * 2.55) for r in out)
