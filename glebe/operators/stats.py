"""Areal statistics: what each variable contributes to each cell, for all dates at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glebe.functions import measure as m
from glebe.functions import overlay as o
from glebe.operators import modes
from glebe.operators.joins import grid_cells, knn_join, lattice_origin, on_grid, points_in_cells, spatial_join
from glebe.operators.ground import united_size
from glebe.operators.layers import computed, dissolve

OUT = [
    "id_cell",
    "date_result",
    "value_num",
    "value_str",
    "inter",
    "cell_prop",
    "var_prop",
    "density",
    "cellvalue_density",
]
FEATURE = ["date_result", "value_num", "value_str", "geom"]


def _sized(data: DataFrame, size) -> DataFrame:
    return (
        data.select(*FEATURE)
        .withColumn("var_size", size("geom"))
        .withColumn("density", F.try_divide(F.col("value_num"), F.col("var_size")))
    )


def _pieces(cells: DataFrame, data: DataFrame, tile: float, hot_rows: int | None) -> DataFrame:
    pairs = spatial_join(data, cells.select("id_cell", "cell_area", "geom"), "intersects", tile, hot_rows)
    return computed(pairs, o.intersection("geom_b", "geom_a")).drop("geom_a", "geom_b")


def _finish(pieces: DataFrame) -> DataFrame:
    return (
        pieces.withColumn("var_prop", F.try_divide(F.col("inter"), F.col("var_size")))
        .withColumn("cellvalue_density", F.col("density") * F.col("inter"))
        .select(*OUT)
    )


def _measured(pieces: DataFrame, size) -> DataFrame:
    return pieces.withColumn("inter", F.coalesce(size("geom"), F.lit(0.0))).drop("geom")


def polygon_stats(
    cells: DataFrame,
    data: DataFrame,
    tile: float = 200.0,
    dissolve_by: str = "value",
    hot_rows: int | None = None,
    lazy: bool = False,
) -> DataFrame:
    """Polygon x cell overlay.

    ``dissolve_by='value'`` unites pieces of a cell that agree in value, size and density,
    ``'feature'`` keeps every distinct feature.  A feature that only touches a cell counts
    with zero area.

    Pieces that agree are measured by ``ground.united_size``, which stores the overlay; ``lazy`` runs nothing and
    unites a cell's pieces of a value in one row, which a group with a large share of the layer does not bear.
    """
    sized_cells = cells.select("id_cell", "geom").withColumn("cell_area", m.area("geom"))
    features = _sized(data, m.area)
    if dissolve_by == "feature" or hot_rows is not None:
        # copies of a feature add nothing to a union and would all meet in one place
        features = features.dropDuplicates(FEATURE)
    pieces = _pieces(sized_cells, features, tile, hot_rows)
    if dissolve_by == "value":
        keys = ["id_cell", "date_result", "value_num", "value_str", "var_size", "density", "cell_area"]
        measured = _measured(dissolve(pieces, keys), m.area) if lazy else united_size(pieces, keys, "area")
    else:
        measured = _measured(pieces, m.area)
    return _finish(measured.withColumn("cell_prop", F.try_divide(F.col("inter"), F.col("cell_area"))))


def line_stats(
    cells: DataFrame,
    data: DataFrame,
    tile: float = 200.0,
    dissolve_by: str = "value",
    hot_rows: int | None = None,
    lazy: bool = False,
) -> DataFrame:
    """Line x cell overlay; a piece's share is taken of all length in the cell. ``lazy`` as in ``polygon_stats``."""
    sized_cells = cells.select("id_cell", "geom").withColumn("cell_area", F.lit(0.0))
    features = _sized(data, m.length)
    if dissolve_by == "feature" or hot_rows is not None:
        # copies of a feature add nothing to a union and would all meet in one place
        features = features.dropDuplicates(FEATURE)
    pieces = _pieces(sized_cells, features, tile, hot_rows)
    if dissolve_by == "value":
        keys = ["id_cell", "date_result", "value_num", "value_str", "var_size", "density"]
        measured = _measured(dissolve(pieces, keys), m.length) if lazy else united_size(pieces, keys, "length")
    else:
        measured = _measured(pieces, m.length)
    # totals are pre-aggregated per map task; a window would send a full cell to one task
    totals = (
        measured.groupBy("id_cell", "date_result")
        .agg(F.sum("inter").alias("_total"))
        .filter(F.col("_total") != 0)
    )
    return _finish(
        measured.join(totals, ["id_cell", "date_result"]).withColumn(
            "cell_prop", F.col("inter") / F.col("_total")
        )
    )


def point_stats(
    cells: DataFrame,
    data: DataFrame,
    num_mode: str | None = None,
    str_mode: str | None = None,
    size: float | None = None,
    tile: float = 200.0,
) -> DataFrame:
    """Value modes of the points of each cell and date."""
    wrong = {x for x in (num_mode, str_mode) if x in modes.SHARE_MODES}
    if wrong:
        raise ValueError(f"modes without a meaning for points: {sorted(wrong)}")
    return per_cell(
        cells, data, size, tile, lambda df, keys: modes.areal_aggregate(df, num_mode, str_mode, keys)
    )


def per_cell(cells: DataFrame, points: DataFrame, size: float | None, tile: float, job) -> DataFrame:
    """Aggregate points per cell and date.

    On a regular grid the aggregate runs on the grid position, so map-side combining
    shrinks a crowded cell before the shuffle and only its result meets the cells.
    """
    data, cells = points.select(*FEATURE), cells.select("id_cell", "geom")
    origin = lattice_origin(cells, size)
    if origin is None:
        return job(points_in_cells(data, cells, None, tile), ["id_cell", "date_result"])
    result = job(on_grid(data, size, origin), ["_gx", "_gy", "date_result"])
    named = result.join(grid_cells(cells, size, origin).drop("geom"), ["_gx", "_gy"])
    return named.drop("_gx", "_gy")


def idw(
    cells: DataFrame, points: DataFrame, k: int = 8, tile: float = 200.0
) -> DataFrame:
    """Inverse-distance mean of the ``k`` nearest known values to each cell centroid.

    A point on the centroid gives its own value (several give their mean).
    """
    known = points.filter(F.col("value_num").isNotNull()).select(
        "date_result", "point_id", "value_num", "geom"
    )
    near = knn_join(cells.select("id_cell", "geom"), known, k, ["date_result"], tile)
    on_spot = F.col("distance") == 0
    w = F.when(~on_spot, 1 / F.col("distance"))
    return near.groupBy("id_cell", "date_result").agg(
        F.coalesce(
            F.avg(F.when(on_spot, F.col("value_num"))), F.sum(F.col("value_num") * w) / F.sum(w)
        ).alias("value_num")
    )


def majority_value(
    cells: DataFrame, points: DataFrame, size: float | None = None, tile: float = 200.0
) -> DataFrame:
    """Most frequent text of each cell and date; equal counts give the first text."""

    def most_frequent(df: DataFrame, keys: list[str]) -> DataFrame:
        text = F.col("value_str")
        rank = F.struct(-F.col("_n"), text.isNull(), text)
        counted = df.groupBy(*keys, "value_str").agg(F.count("*").alias("_n"))
        return counted.groupBy(*keys).agg(F.min_by("value_str", rank).alias("value_str"))

    return per_cell(cells, points, size, tile, most_frequent)


def combine_modes(numeric: DataFrame | None, text: DataFrame | None) -> DataFrame:
    """Full outer merge of a numeric and a text result on cell and date."""
    keys = ["id_cell", "date_result"]
    if text is None:
        return numeric.select(*keys, "value_num", F.lit(None).cast("string").alias("value_str"))
    if numeric is None:
        return text.select(*keys, F.lit(None).cast("double").alias("value_num"), "value_str")
    return numeric.select(*keys, "value_num").join(text.select(*keys, "value_str"), keys, "full")


__all__ = [
    "combine_modes",
    "idw",
    "line_stats",
    "majority_value",
    "point_stats",
    "polygon_stats",
]
