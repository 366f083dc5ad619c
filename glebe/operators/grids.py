"""Reference tables, grids and observation datasets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glebe.functions.numbering import number_rows
from glebe.functions import overlay as o
from glebe.functions import project
from glebe.operators.joins import spatial_join
from glebe.operators.layers import dissolve


def upsert_ref(ref: DataFrame, rows: DataFrame, key: str, id_col: str) -> DataFrame:
    """Reference table with the rows whose natural key it lacks, under the next ids."""
    fresh = rows.filter(F.col(key).isNotNull()).dropDuplicates([key]).join(
        ref.select(key), key, "left_anti"
    )
    top = ref.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("m")).first()["m"]
    return ref.unionByName(number_rows(fresh, [key], id_col, int(top)), allowMissingColumns=True)


def _source_cells(source: DataFrame, code: str, id_grid: int, srid: int) -> DataFrame:
    return source.select(
        F.col(code).cast("string").alias("cell_code"),
        F.lit(id_grid).alias("id_grid"),
        "geom",
    ).withColumn("geom", project.transform_to("geom", srid))


def build_grid(
    cells: DataFrame | None,
    source: DataFrame,
    id_grid: int,
    code: str = "cell_code",
    mode: str = "deleteall",
    srid: int = 2154,
) -> DataFrame:
    """Cells after loading one grid.

    ``deleteall`` (also the first load) replaces the grid's cells, ``adddiff`` adds the
    codes it lacks, ``updategeom`` takes the source geometry where the code matches.
    """
    given = _source_cells(source, code, id_grid, srid)
    if cells is None:
        return number_rows(given, ["cell_code"], "id_cell")
    mine = F.col("id_grid") == id_grid
    if mode.lower() == "updategeom":
        shapes = given.select(
            "cell_code", "id_grid", F.struct("geom").alias("_new")
        ).dropDuplicates(["cell_code", "id_grid"])
        return (
            cells.join(shapes, ["cell_code", "id_grid"], "left")
            .withColumn("geom", F.when(F.col("_new").isNotNull(), F.col("_new.geom")).otherwise(F.col("geom")))
            .drop("_new")
        )
    kept = cells.filter(~mine) if mode.lower() == "deleteall" else cells
    fresh = given if mode.lower() == "deleteall" else missing_codes(given, cells.filter(mine))
    top = kept.agg(F.coalesce(F.max("id_cell"), F.lit(0)).alias("m")).first()["m"]
    return kept.unionByName(number_rows(fresh, ["cell_code"], "id_cell", int(top)))


def missing_codes(source: DataFrame, existing: DataFrame, code: str = "cell_code") -> DataFrame:
    """Source rows whose code is not loaded yet; rows without a code are left out."""
    return source.filter(F.col(code).isNotNull()).join(
        existing.filter(F.col(code).isNotNull()).select(code).distinct(), code, "left_anti"
    )


def cross_grid(
    cells: DataFrame,
    mask: DataFrame,
    condition: str | None = None,
    srid: int = 2154,
    tile: float = 200.0,
    hot_rows: int | None = None,
) -> DataFrame:
    """Cells cut to a filtered mask, one geometry per cell code: the source of a new grid."""
    chosen = mask.filter(F.expr(condition)) if condition else mask
    pairs = spatial_join(
        chosen.select("geom"), cells.select("cell_code", "geom"), "intersects", tile, hot_rows
    )
    pieces = pairs.select("cell_code", o.intersection("geom_b", "geom_a").alias("geom")).filter(
        F.coalesce(F.size("geom.parts") != 0, F.lit(True))
    )
    return dissolve(pieces, ["cell_code"]).withColumn("geom", project.transform_to("geom", srid))


@dataclass(frozen=True)
class DatasetSpec:
    """How a source table becomes observations of one variable."""

    id_variable: int
    reference_date: str  # a dd/mm/yyyy date, or the name of a date column
    source_column: str = ""
    is_numeric: bool = False
    use_field_str: str = ""
    json_expression: str = ""
    source_condition: str = ""

    @property
    def fixed_date(self) -> bool:
        import re

        return re.fullmatch(r"\d{1,2}/\d{1,2}/\d{4}", self.reference_date) is not None


def build_dataset(source: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Observations of a variable; with a date column every date is built in one pass."""
    rows = source.filter(F.expr(spec.source_condition)) if spec.source_condition else source
    date = (
        F.to_date(F.lit(spec.reference_date), "d/M/yyyy")
        if spec.fixed_date
        else F.to_date(F.col(spec.reference_date))
    )
    none_num, none_str = F.lit(None).cast("double"), F.lit(None).cast("string")
    value_num, value_str = none_num, none_str
    if spec.source_column:
        column = F.col(spec.source_column)
        value_num = column.cast("double") if spec.is_numeric else none_num
        value_str = none_str if spec.is_numeric else column.cast("string")
    if spec.use_field_str:
        value_str = F.col(spec.use_field_str).cast("string")
    info = F.expr(spec.json_expression).cast("string") if spec.json_expression else none_str
    return rows.select(
        date.alias("date_result"),
        F.lit(spec.id_variable).cast("bigint").alias("id_variable"),
        "geom",
        value_str.alias("value_str"),
        value_num.alias("value_num"),
        info.alias("info"),
    )
