"""From an indicator specification to published results."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glebe.operators import modes, results, stats
from glebe.session import cut_lineage
from glebe.sources import sinks

NEAREST = "value_invdist_pt"
MAJORITY = ("value_str_mode_ct_pt", "prop_elt")


@dataclass(frozen=True)
class IndicatorSpec:
    id_indicator: int
    id_variable: int
    id_grid: int
    num_mode: str = ""
    str_mode: str = ""
    per_feature: bool = False  # keep features of equal value apart
    condition_variable: str = ""
    kind: str | None = None  # polygon, line or point; read from the data when None
    tile: float = 200.0
    cell_size: float | None = None  # side of the squares of a regular grid
    hot_rows: int | None = None


def geometry_kind(data: DataFrame) -> str | None:
    """Kind of the first geometry of the variable."""
    row = data.filter(F.col("geom").isNotNull()).select(F.col("geom.kind").alias("k")).first()
    return row["k"] if row else None


def _neighbours(mode: str) -> int:
    return int(mode.split("#")[1]) if "#" in mode else 8


def _point_results(cells: DataFrame, data: DataFrame, spec: IndicatorSpec) -> DataFrame:
    num, text = spec.num_mode, spec.str_mode.strip()
    near, most = num.startswith(NEAREST), text in MAJORITY
    if not near and not most:
        return stats.point_stats(cells, data, num, text, spec.cell_size, spec.tile)
    numeric = words = None
    if near:
        if "point_id" not in data.columns:
            # equal distances need some fixed order of the points
            data = data.withColumn("point_id", F.xxhash64("geom", "value_num", "value_str"))
        numeric = stats.idw(cells, data, _neighbours(num), spec.tile * 2)
    elif num:
        numeric = stats.point_stats(cells, data, num, None, spec.cell_size, spec.tile)
    if most:
        words = stats.majority_value(cells, data, spec.cell_size, spec.tile)
    elif text:
        words = stats.point_stats(cells, data, None, text, spec.cell_size, spec.tile)
    return stats.combine_modes(numeric, words)


def compute_indicator(cells: DataFrame, data: DataFrame, spec: IndicatorSpec) -> DataFrame:
    """Results of all dates of the variable in one plan; ``date_result`` is a group key."""
    if spec.condition_variable:
        data = data.filter(F.expr(spec.condition_variable))
    kind = spec.kind or geometry_kind(data)
    how = "feature" if spec.per_feature else "value"
    if kind == "point":
        found = _point_results(cells, data, spec)
    elif kind in ("polygon", "line"):
        overlay = stats.polygon_stats if kind == "polygon" else stats.line_stats
        found = modes.areal_aggregate(
            overlay(cells, data, spec.tile, how, spec.hot_rows), spec.num_mode, spec.str_mode
        )
    else:
        raise ValueError(f"no geometry to compute indicator {spec.id_indicator} from")
    return found.select(
        "date_result",
        F.lit(spec.id_indicator).cast("bigint").alias("id_indicator"),
        "id_cell",
        "value_str",
        "value_num",
    )


def build_indicator(
    cells: DataFrame,
    datasets: DataFrame,
    spec: IndicatorSpec,
    existing: DataFrame | None = None,
) -> DataFrame:
    """Results of a specification over the stored observations.

    With ``existing`` results only the dates that miss a cell are computed again.
    """
    grid = cells.filter(F.col("id_grid") == spec.id_grid)
    data = datasets.filter(F.col("id_variable") == spec.id_variable)
    if existing is not None:
        done = existing.filter(F.col("id_indicator") == spec.id_indicator)
        kind = spec.kind or geometry_kind(data)
        size = spec.cell_size if kind == "point" else None
        # features that the condition leaves out give no result to wait for
        counted = data.filter(F.expr(spec.condition_variable)) if spec.condition_variable else data
        open_cells = results.cells_to_compute(grid, counted, done, spec.tile, size, kind)
        data = data.join(results.dates_to_rebuild(open_cells), "date_result", "left_semi")
        spec = replace(spec, kind=kind)  # nothing may be left to read it from
    return compute_indicator(grid, data, spec)


def publish(found: DataFrame, path: str, log_path: str, user: str, rebuilt: Sequence[int] = ()) -> None:
    """Replace the (indicator, date) partitions of the results and log each of them.

    ``rebuilt`` names the indicators built from scratch: their stored dates that ``found``
    lacks are removed.
    """
    found = cut_lineage(found)  # written twice, and may have been read from ``path``
    for id_indicator in rebuilt:
        mine = found.filter(F.col("id_indicator") == id_indicator).drop("id_indicator")
        sinks.replace_partitions(mine, f"{path}/id_indicator={id_indicator}", ["date_result"])
    resumed = found.filter(~F.col("id_indicator").isin(list(rebuilt))) if rebuilt else found
    sinks.save_partition(resumed, path, ["id_indicator", "date_result"])
    sinks.append_log(sinks.log_update(found, "indicator", "id_indicator", user), log_path)
