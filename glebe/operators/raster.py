"""Images as pixel tables ``scene, row, col, b array<double>``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glebe.functions import geometry as g
from glebe.functions import overlay as o
from glebe.operators.joins import spatial_join, tiled

PIXEL = ["scene", "row", "col"]


def stack_bands(frames: Sequence[DataFrame]) -> DataFrame:
    """One array of bands per pixel that every input has, in input order."""
    named = [f.select(*PIXEL, F.col("b").alias(f"_b{i}")) for i, f in enumerate(frames)]
    joined = reduce(lambda a, b: a.join(b, PIXEL), named)
    return joined.select(*PIXEL, F.concat(*[F.col(f"_b{i}") for i in range(len(frames))]).alias("b"))


def mosaic(scenes: Sequence[DataFrame]) -> DataFrame:
    """Scenes laid over each other on one pixel lattice; the last one covering a pixel wins."""
    ranked = [s.select("row", "col", "b", F.lit(i).alias("_p")) for i, s in enumerate(scenes)]
    every = reduce(DataFrame.unionByName, ranked)
    return every.groupBy("row", "col").agg(F.max_by("b", "_p").alias("b")).select(
        F.lit(0).alias("scene"), "row", "col", "b"
    )


def with_centres(px: DataFrame, size: float) -> DataFrame:
    """Pixel centres as a point layer."""
    return px.withColumn(
        "geom", g.xy_point((F.col("col") + 0.5) * size, (F.col("row") + 0.5) * size)
    )


def clip_pixels(px: DataFrame, mask: DataFrame, size: float, tile: float = 400.0) -> DataFrame:
    """Pixels whose centre lies in the mask."""
    points = tiled(with_centres(px, size).withColumnRenamed("geom", "geom_a"), tile, "geom_a")
    areas = tiled(mask.select(F.col("geom").alias("geom_b")), tile, "geom_b")
    met = (
        (points["_tx"] == areas["_tx"])
        & (points["_ty"] == areas["_ty"])
        & o.intersects("geom_a", "geom_b")
    )
    return points.join(areas, met, "left_semi").select(*px.columns)


def dynamic_convert(
    px: DataFrame,
    n_bands: int,
    low: float = 0.0,
    high: float = 255.0,
    q: float = 0.02,
    exact: bool = True,
    scene: str = "scene",
) -> DataFrame:
    """Each band clamped to its ``q`` and ``1 - q`` quantiles and stretched to low..high.

    Pixels with a column ``scene`` are stretched scene by scene.

    The exact quantile keeps a count per distinct value, which suits integer pixels;
    ``exact=False`` takes the sketch for real-valued ones.
    """
    qs = F.array(F.lit(q), F.lit(1 - q))

    def quantiles(i: int) -> Column:
        band = F.get("b", F.lit(i))
        return F.percentile(band, qs) if exact else F.percentile_approx(band, qs, 100_000)

    scenes = [scene] if scene in px.columns else []
    bounds = px.groupBy(*[F.col(s).alias("_scene") for s in scenes]).agg(*[quantiles(i).alias(f"_q{i}") for i in range(n_bands)])

    def stretch(i: int) -> Column:
        lo, hi = F.get(f"_q{i}", F.lit(0)), F.get(f"_q{i}", F.lit(1))
        band = F.least(F.greatest(F.get("b", F.lit(i)), lo), hi)
        return F.coalesce(low + F.try_divide((band - lo) * (high - low), hi - lo), F.lit(low))

    # without scenes there is one row of bounds
    bounded = px.join(bounds, F.col(scene).eqNullSafe(F.col("_scene"))) if scenes else px.join(F.broadcast(bounds))
    return bounded.select(
        *PIXEL, *scenes, F.array(*[stretch(i) for i in range(n_bands)]).alias("b")
    )


def ndvi(px: DataFrame, red: int = 3, infrared: int = 4, out: str = "ndvi") -> DataFrame:
    """``((ir - red) / (ir + red) + 1) * 100`` of 1-based bands; NULL for a zero sum."""
    r, i = F.get("b", F.lit(red - 1)), F.get("b", F.lit(infrared - 1))
    return px.withColumn(out, (F.try_divide(i - r, i + r) + 1) * 100)


FEATURES = (
    "energy",
    "entropy",
    "correlation",
    "inverse_difference",
    "inertia",
    "cluster_shade",
    "cluster_prominence",
    "haralick_correlation",
)


BLOCK = 64  # pixels along the side of a square whose windows are summed together

#: factors of a count of the pair (i, j)
_WEIGHTS = {
    "t": lambda i, j: 1.0,
    "si": lambda i, j: i,
    "sii": lambda i, j: i * i,
    "sij": lambda i, j: i * j,
    "idm": lambda i, j: 1 / (1 + (i - j) ** 2),
    "dd": lambda i, j: (i - j) ** 2,
    "s1": lambda i, j: i + j,
    "s2": lambda i, j: (i + j) ** 2,
    "s3": lambda i, j: (i + j) ** 3,
    "s4": lambda i, j: (i + j) ** 4,
}


def haralick(
    px: DataFrame,
    value: str,
    radius: int = 5,
    offset: tuple[int, int] = (3, 3),
    nbins: int = 8,
    low: float = 0.0,
    high: float = 255.0,
    symmetric: bool = True,
) -> DataFrame:
    """Eight texture features per pixel from grey-level co-occurrence in its window.

    Pairs are counted per pixel; squares of ``BLOCK`` pixels with a rim of ``radius`` around them then sum their windows.
    So a pixel travels once, or a few times near the border of its square, and a task holds one square.
    """
    v = F.col(value)
    bins = F.least(F.greatest(F.floor((v - low) / (high - low) * nbins), F.lit(0)), F.lit(nbins - 1))
    grey = px.filter(v.isNotNull()).select("scene", "row", "col", bins.cast("int").alias("i"))
    dx, dy = offset
    other = grey.select(
        "scene", (F.col("row") - dy).alias("row"), (F.col("col") - dx).alias("col"), F.col("i").alias("j")
    )
    pairs = grey.join(other, PIXEL)
    if symmetric:
        both = F.array(
            F.struct(F.col("i").alias("i"), F.col("j").alias("j")),
            F.struct(F.col("j").alias("i"), F.col("i").alias("j")),
        )
        pairs = pairs.select(*PIXEL, F.explode(both).alias("p")).select(*PIXEL, "p.i", "p.j")

    counted = pairs.groupBy(*PIXEL, "i", "j").agg(F.count("*").alias("n"))

    def blocks(name: str, rim: int) -> Column:
        return F.explode(F.sequence(F.floor((F.col(name) - rim) / BLOCK), F.floor((F.col(name) + rim) / BLOCK)))

    def dealt(rows: DataFrame, rim: int) -> DataFrame:
        return rows.withColumn("_by", blocks("row", rim)).withColumn("_bx", blocks("col", rim))

    # a pixel to be described is a row without a pair
    none = F.lit(None).cast("int")
    asked = grey.select(*PIXEL).dropna().distinct().select(*PIXEL, none.alias("i"), none.alias("j"), F.lit(0).cast("bigint").alias("n"))
    whole = dealt(counted, radius).unionByName(dealt(asked, 0)).groupBy("scene", "_by", "_bx").applyInPandas(
        _window_sums(radius), T.StructType([px.schema[c] for c in PIXEL] + [T.StructField(k, T.DoubleType()) for k in (*_WEIGHTS, "nn", "nl", "mm")])
    )
    return _features(whole, nbins)


def _window_sums(radius: int):
    """Sums over the co-occurrence counts of each asked pixel's window, for the rows of one square of pixels."""

    def sums(rows: pd.DataFrame) -> pd.DataFrame:
        y0, x0 = (int(rows[k].iloc[0]) * BLOCK for k in ("_by", "_bx"))
        asked = rows[rows["i"].isna()]
        y, x = (asked["row"] - y0).to_numpy(int), (asked["col"] - x0).to_numpy(int)
        out = {k: np.zeros(len(asked)) for k in (*_WEIGHTS, "nn", "nl", "mm")}
        for i, same in rows[rows["i"].notna()].groupby("i"):
            own = np.zeros(len(asked))
            for j, pair in same.groupby("j"):
                # summed area table: its corners give the count of any window
                table = np.zeros((BLOCK + 2 * radius + 1,) * 2)
                np.add.at(table, ((pair["row"] - y0 + radius + 1).to_numpy(int), (pair["col"] - x0 + radius + 1).to_numpy(int)), pair["n"].to_numpy())
                table = table.cumsum(0).cumsum(1)
                w = 2 * radius + 1
                n = table[y + w, x + w] - table[y, x + w] - table[y + w, x] + table[y, x]
                for k, weight in _WEIGHTS.items():
                    out[k] += n * weight(i, j)
                out["nn"] += n * n
                out["nl"] += n * np.log2(np.maximum(n, 1))
                own += n
            out["mm"] += own * own
        found = asked[PIXEL].assign(**out)
        return found[found["t"] > 0]

    return sums


def _features(whole: DataFrame, nbins: int) -> DataFrame:
    # from sums to expectations
    t = F.col("t")
    e = {k: F.col(k) / t for k in ("si", "sii", "sij", "s1", "s2", "s3", "s4")}
    mean = e["si"]
    var = e["sii"] - mean * mean
    c = 2 * mean
    marginal_mean = 1.0 / nbins
    marginal_var = F.col("mm") / (t * t) / nbins - marginal_mean**2
    cross = e["sij"] - mean * e["s1"] + mean * mean
    shade = e["s3"] - 3 * c * e["s2"] + 3 * c * c * e["s1"] - c * c * c
    prominence = (
        e["s4"] - 4 * c * e["s3"] + 6 * c * c * e["s2"] - 4 * c * c * c * e["s1"] + c * c * c * c
    )
    flat = F.abs(var) < 1e-12
    even = F.abs(marginal_var) < 1e-12
    return whole.select(
        *PIXEL,
        (F.col("nn") / (t * t)).alias("energy"),
        (F.log2(t) - F.col("nl") / t).alias("entropy"),
        F.when(~flat, cross / var).alias("correlation"),
        (F.col("idm") / t).alias("inverse_difference"),
        (F.col("dd") / t).alias("inertia"),
        shade.alias("cluster_shade"),
        prominence.alias("cluster_prominence"),
        F.when(~even, (e["sij"] - marginal_mean**2) / marginal_var).alias("haralick_correlation"),
    )


def zonal_stats(
    px: DataFrame,
    zones: DataFrame,
    n_bands: int,
    size: float,
    key: str = "fid",
    tile: float = 400.0,
    hot_rows: int | None = None,
    sample: bool = False,
) -> DataFrame:
    """Per zone: pixel count and ``mean{i}, stdev{i}, min{i}, max{i}`` of each band.

    ``sample`` takes the sample deviation instead of the population one.
    """
    inside = spatial_join(
        with_centres(px, size), zones.select(key, "geom"), "intersects", tile, hot_rows
    )
    deviation = F.stddev_samp if sample else F.stddev_pop

    def band_stats(i: int) -> list[Column]:
        b = F.get("b", F.lit(i))
        return [
            F.avg(b).alias(f"mean{i}"),
            deviation(b).alias(f"stdev{i}"),
            F.min(b).alias(f"min{i}"),
            F.max(b).alias(f"max{i}"),
        ]

    return inside.groupBy(key).agg(
        F.count("*").alias("count"), *[c for i in range(n_bands) for c in band_stats(i)]
    )
