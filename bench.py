"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from glebe import fixtures as fx
from glebe.operators import joins, modes, parcels, raster, stats
from glebe.session import cut_lineage, local_session
from pyspark.sql import functions as F

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8)))


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session(CPUS)
    cells = fx.cells(spark, SF_DIR)

    def weighted_mean():
        found = stats.polygon_stats(cells, fx.poly_data(spark, SF_DIR))
        run(modes.areal_aggregate(found, "md_prop", "value_str_mode_inter"))

    def per_feature():
        found = stats.polygon_stats(cells, fx.poly_data(spark, SF_DIR), dissolve_by="feature")
        run(modes.areal_aggregate(found, "prop_surf"))

    def lines():
        run(modes.areal_aggregate(stats.line_stats(cells, fx.lines(spark, SF_DIR)), "prop_len"))

    def points():
        run(stats.point_stats(cells, fx.points(spark, SF_DIR), "val_avg", "value_str_agg", 200.0))

    def overlap_pairs():
        run(joins.overlap_pairs(fx.parcels_a(spark, SF_DIR)))

    def nearest():
        run(stats.idw(cells, fx.points(spark, SF_DIR), 8, 800.0))

    def texture():
        px = fx.pixels(spark, SF_DIR).withColumn("v", F.get("b", F.lit(3)))
        run(raster.haralick(px, "v"))

    def zonal():
        run(raster.zonal_stats(fx.pixels(spark, SF_DIR), cells.withColumnRenamed("id_cell", "fid"), 4, 40.0))

    def envelopes():
        layer = fx.parcels_a(spark, SF_DIR)
        pairs = cut_lineage(joins.overlap_pairs(layer))
        run(parcels.minimal_envelope(layer, joins.mirrored(pairs).select("fid", "inter_geom"), gap=0.0))

    # minutes at the default scale, so only on request (BENCH_ONLY=P_clean_parcels)
    def clean():
        run(parcels.clean_parcels(fx.parcels_a(spark, SF_DIR)))

    jobs = {
        "I1_weighted_mean": weighted_mean,
        "I1b_per_feature": per_feature,
        "I2_lines": lines,
        "I3_points": points,
        "J2_overlap_pairs": overlap_pairs,
        "I4_idw": nearest,
        "X6_haralick": texture,
        "X7_zonal": zonal,
        "P4_envelopes": envelopes,
    }
    only = os.environ.get("BENCH_ONLY")
    if only:
        every = {**jobs, "P_clean_parcels": clean}
        jobs = {k: v for k, v in every.items() if k in only.split(",")}
    points()  # starts the session's code generation
    took = {}
    for name, job in jobs.items():
        t = time.time()
        job()
        took[name] = round(time.time() - t, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total_wall",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
