"""Published indicator results: completeness, pivots, re-attachment to cells."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glebe.functions import measure as m
from glebe.functions import overlay as o
from glebe.operators.joins import points_in_cells, spatial_join

VALUE = {"num": "value_num", "str": "value_str"}


def results_with_cells(results: DataFrame, cells: DataFrame) -> DataFrame:
    """Every result with its cell code and geometry."""
    return results.join(cells.select("id_cell", "cell_code", "geom"), "id_cell")


def has_values(results: DataFrame, kind: str) -> bool:
    return not results.filter(F.col(VALUE[kind]).isNotNull()).limit(1).isEmpty()


def result_dates(results: DataFrame) -> list[dt.date]:
    """Distinct dates of an indicator, oldest first: they become columns."""
    return [r[0] for r in results.select("date_result").distinct().orderBy("date_result").collect()]


def pivot_results(
    results: DataFrame, cells: DataFrame, kind: str, dates: Sequence[dt.date] | None = None
) -> DataFrame | None:
    """One row per cell with a ``value_YYYYMMDD`` column per date; None without such values.

    Values are pivoted before the cells are joined, so geometries are not aggregated.
    Two values of one cell and date give the smaller one.
    """
    if not has_values(results, kind):
        return None
    value = VALUE[kind]
    dates = list(dates) if dates is not None else result_dates(results)
    wide = (
        results.filter(F.col(value).isNotNull())
        .groupBy("id_cell")
        .agg(
            *[
                F.min(F.when(F.col("date_result") == F.lit(d), F.col(value))).alias(
                    f"value_{d:%Y%m%d}"
                )
                for d in dates
            ]
        )
    )
    return cells.select("id_cell", "cell_code", "geom").join(wide, "id_cell")


def pivot_on_grid(pivot: DataFrame, cells: DataFrame, id_grid: int) -> DataFrame:
    """The pivot's values with the geometry another grid has for the same cell code."""
    other = cells.filter(F.col("id_grid") == id_grid).select("cell_code", "geom")
    return pivot.drop("geom").join(other, "cell_code")


def save_pivot(pivot: DataFrame, path: str) -> None:
    pivot.write.mode("overwrite").parquet(path)


def cells_to_compute(
    cells: DataFrame,
    data: DataFrame,
    results: DataFrame,
    tile: float = 200.0,
    point_size: float | None = None,
    kind: str | None = None,
) -> DataFrame:
    """(cell, date) that meet data but have no result yet; a line must run inside the cell."""
    keys = ["id_cell", "date_result"]
    observed, sites = data.select("date_result", "geom"), cells.select("id_cell", "geom")
    met = (
        spatial_join(observed, sites, "intersects", tile)
        if point_size is None
        else points_in_cells(observed, sites, point_size, tile)
    )
    if kind == "line":
        met = met.filter(m.length(o.intersection("geom_b", "geom_a")) > 0)
    return met.select(*keys).distinct().join(results.select(*keys).distinct(), keys, "left_anti")


def dates_to_rebuild(to_compute: DataFrame) -> DataFrame:
    return to_compute.select("date_result").distinct()
