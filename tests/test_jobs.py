from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from glebe.functions import geometry as g
from glebe.functions import measure as m
from glebe.functions.numbering import number_rows
from glebe.operators import joins, modes, parcels, stats, vintages
from glebe.session import cut_lineage
from glebe.sources import sinks, typing


def boxes(spark, rows, extra=""):
    rows = [(r[0], *map(float, r[1:])) for r in rows]
    df = spark.createDataFrame(rows, f"fid bigint, a double, b double, c double, d double{extra}")
    return df.withColumn("geom", g.rectangle(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).drop("a", "b", "c", "d")


def test_clean_keeps_area_and_removes_overlap(spark):
    layer = boxes(spark, [(1, 0, 0, 20, 20), (2, 15, 0, 40, 20), (3, 60, 0, 80, 20), (4, 61, 1, 70, 10)])
    out = parcels.clean_parcels(layer, gap_in=0, gap_many=0, gap_out=0)
    got = {(r["fid1"], r["step"]): r["area"] for r in out.withColumn("area", m.area("geom")).collect()}
    # nested 3 and 4 are not overlaps; the shared strip touches both envelopes along 20 m: a tie
    assert got == {
        (1, "left_min_env"): 300.0, (2, "reconstruit"): 500.0, (3, "Report"): 400.0, (4, "Report"): 81.0,
    }


def _overlapping(cleaned):
    layer = cleaned.select(F.monotonically_increasing_id().alias("fid"), "geom").checkpoint()
    return joins.overlap_pairs(layer).filter(m.area("inter_geom") > 1e-3).count()


def test_default_cleaning_of_a_row_of_parcels_leaves_no_overlap(spark):
    layer = boxes(spark, [(k, 30 * k, 0, 30 * k + 40, 40) for k in range(4)])
    out = cut_lineage(parcels.clean_parcels(layer))
    assert _overlapping(out) == 0
    assert out.agg(F.sum(m.area("geom"))).first()[0] == pytest.approx(130 * 40, abs=10)


def test_ground_shared_by_three_parcels_has_one_owner(spark):
    layer = boxes(spark, [(1, 0, 0, 40, 40), (2, 30, 0, 60, 40), (3, 0, 30, 40, 90)])
    for gap in (0.0, 0.001):
        out = cut_lineage(parcels.clean_parcels(layer, gap_in=gap, gap_out=gap, each_once=True))
        assert _overlapping(out) == 0
        assert out.agg(F.sum(m.area("geom"))).first()[0] == pytest.approx(4400, abs=2)  # 1600 + 1200 + 2400 - (400 + 400 + 100) + 100


def test_pile_of_copies_gives_each_copy_its_pair(spark):
    rows = [(k, 0.0, 0.0, 20.0, 20.0) for k in range(50)] + [(99, 10.0, 10.0, 30.0, 30.0)]
    pairs = joins.overlap_pairs(boxes(spark, rows)).collect()
    assert sorted((r["fid1"], r["fid2"]) for r in pairs) == [(k, 99) for k in range(50)]


def test_join_result_does_not_depend_on_tile_salt_or_partitions(spark):
    rows = [(k, (k * 37) % 101, (k * 53) % 97, (k * 37) % 101 + 9, (k * 53) % 97 + 7) for k in range(200)]
    rows = [tuple([r[0], *map(float, r[1:])]) for r in rows]
    a = boxes(spark, rows)
    b = boxes(spark, rows).withColumnRenamed("fid", "other")

    def run(**kw):
        return sorted(tuple(r) for r in joins.spatial_join(a, b, "intersects", **kw).select("fid", "other").collect())

    base = run(tile=10.0)
    assert len(base) > 200
    assert base == run(tile=1000.0) == run(tile=1000.0, hot_rows=7) == run(tile=13.0, hot_rows=1)
    assert base == sorted(tuple(r) for r in joins.spatial_join(a.repartition(3), b.repartition(5), "intersects", 25.0).select("fid", "other").collect())


def _env(spark, rows):
    return boxes(spark, rows)


def test_kept_pieces_join_small_envelopes_once(spark):
    pairs = spark.createDataFrame([(1, 11), (1, 12), (2, 12), (3, 13)], "id1 bigint, id2 bigint")
    x = F.col("id1") * 100 + F.col("id2")
    decisions = pairs.select("id1", "id2", F.lit("Suff_area").alias("step"), g.rectangle(x, F.lit(0), x + 20, F.lit(10)).alias("inter_geom"))
    # 1 large, 2 small, 3 thin and small; 11 missing, 12 small, 13 small and thin
    new = _env(spark, [(1, 0.0, 100.0, 20.0, 120.0), (2, 0.0, 200.0, 10.0, 210.0), (3, 0.0, 300.0, 5000.0, 300.01)])
    old = _env(spark, [(12, 0.0, 400.0, 10.0, 405.0), (13, 0.0, 500.0, 5000.0, 500.01)])
    out = vintages.resolve_kept(decisions, new, old)
    got = sorted((r["detail"], r["id1"] or 0, r["id2"] or 0, round(r["area"], 3)) for r in out.withColumn("area", m.area("geom")).collect())
    assert got == [
        ("P2-t1-2_agg", 2, 12, 300.0),  # own envelope joined; the old one went to its first pair
        ("P2-t1-2_agg", 3, 13, 250.0),  # thin new envelope refused, thin old one taken
        ("P2-t1_keep", 1, 0, 400.0),
        ("P2-t2_agg", 1, 11, 200.0),  # missing envelope: the piece alone
        ("P2-t2_agg", 1, 12, 250.0),
    ]


def test_chain_of_four_vintages_keeps_lineage(spark):
    def year(dx, base):
        rows = [(base + k, 50.0 * k + dx, 0.0, 50.0 * k + dx + 40, 30.0) for k in range(4)]
        return boxes(spark, rows)

    out = vintages.chain_vintages([year(0.0, 100), year(6.0, 200), year(12.0, 300), year(18.0, 400)])
    rows = out.select("id", "fid20", "fid19", "fid18", "fid17", m.area("geom").alias("a")).collect()
    assert len({r["id"] for r in rows}) == len(rows)
    assert any(r["fid20"] and r["fid19"] and r["fid18"] and r["fid17"] for r in rows)
    assert all(r["a"] >= 99 for r in rows)


def test_modes_edge_cases(spark):
    df = spark.createDataFrame([(1, None, "b"), (1, 2.5, "a,x"), (1, 2.0, None)], "id_cell int, value_num double, value_str string")
    df = df.withColumn("date_result", F.lit(1))

    def one(num=None, text=None):
        r = modes.areal_aggregate(df, num, text).first()
        return r["value_num"], r["value_str"]

    assert one(text="value_num_agg")[1] == "{2,2.5,NULL}"
    assert one(text="value_str_agg")[1] == '{"a,x",b,NULL}'
    assert one(num="val_median")[0] == 2.25
    single = modes.areal_aggregate(df.filter("value_num = 2"), "val_stddev", "plus_stats").first()
    assert single["value_num"] is None and '"stddev_value":""' in single["value_str"]
    with pytest.raises(ValueError):
        modes.mode_column("nope", "double")
    with pytest.raises(ValueError):
        stats.point_stats(df, df, "prop_surf")


def test_point_on_corner_and_on_centroid(spark):
    cells = spark.range(4).select(
        F.col("id").alias("id_cell"),
        g.rectangle((F.col("id") % 2) * 10, F.floor(F.col("id") / 2) * 10, (F.col("id") % 2) * 10 + 10, F.floor(F.col("id") / 2) * 10 + 10).alias("geom"),
    )
    pts = spark.createDataFrame([(1, 10.0, 10.0, 7.0), (2, 5.0, 5.0, 3.0)], "point_id bigint, x double, y double, value_num double")
    pts = pts.select("point_id", "value_num", F.lit("t").alias("value_str"), F.lit(dt.date(2020, 1, 1)).alias("date_result"), g.xy_point(F.col("x"), F.col("y")).alias("geom"))
    for size in (10.0, None):
        got = stats.point_stats(cells, pts, "ct_elt", None, size, 10.0).collect()
        assert sorted((r["id_cell"], r["value_num"]) for r in got) == [(0, 2.0), (1, 1.0), (2, 1.0), (3, 1.0)]
    near = {r["id_cell"]: r["value_num"] for r in stats.idw(cells, pts, 8, 4.0).collect()}
    assert near[0] == 3.0 and len(near) == 4


def test_inference_and_casts(spark):
    df = spark.createDataFrame(
        [("0.5", "007", "05/06/2020", "oui", "12"), ("1,25", "12", "25/06/2020", "n", ""), ("", "", "", "", "-3")],
        "num string, code string, day string, flag string, whole string",
    )
    kinds = typing.infer_types(df, df.columns)
    assert kinds == {"num": "numeric", "code": "text", "day": "date", "flag": "boolean", "whole": "bigint"}
    assert typing.best_date_format(df, "day") == "d/M/yyyy"
    out = [r[0] for r in typing.cast_typed(df, "flag", "boolean").select("flag").collect()]
    assert out == [True, False, None]
    assert [str(r[0]) for r in typing.cast_typed(df, "num", "numeric").select("num").collect()][1] == "1.2500000000"


def test_sinks_guard_keys_and_rewrite_only_their_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(ValueError):
        sinks.save_table(df, str(tmp_path / "t"), primary_key=["k"])
    path = str(tmp_path / "p")
    rows = spark.createDataFrame([(1, 1, 5), (1, 2, 6), (2, 1, 7)], "i int, d int, v int")
    sinks.save_partition(rows, path, ["i", "d"])
    sinks.save_partition(spark.createDataFrame([(1, 2, 60)], "i int, d int, v int"), path, ["i", "d"])
    assert sorted((r["i"], r["d"], r["v"]) for r in spark.read.parquet(path).collect()) == [(1, 1, 5), (1, 2, 60), (2, 1, 7)]


def test_numbers_are_consecutive_and_stable(spark):
    df = spark.range(500).withColumn("k", F.col("id") * 7 % 501)
    one = {r["k"]: r["n"] for r in number_rows(df, ["k"], "n", 10, 16).collect()}
    two = {r["k"]: r["n"] for r in number_rows(df.repartition(7), ["k"], "n", 10, 16).collect()}
    assert one == two and sorted(one.values()) == list(range(11, 511))
