"""Geometry of loaded tables: coordinate text, keys of a reference layer, x/y columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glebe.functions import geometry as g
from glebe.functions import project, wkt

# fixed values: beginnings of projection texts and their systems
PROJECTIONS = (
    ('GEOGCS["GCS_WGS_1984"', 4326),
    ('PROJCS["Lambert_Conformal_Conic"', 2154),
    ('PROJCS["RGF_1993_Lambert_93"', 2154),
    ('PROJCS["RGF93_Lambert_93"', 2154),
)


def srid_from_prj(text: Column) -> Column:
    """System named by a projection text, NULL when unknown."""
    found = F.lit(None).cast("int")
    for start, srid in reversed(PROJECTIONS):
        found = F.when(F.lower(text).startswith(start.lower()), F.lit(srid)).otherwise(found)
    return found


def read_vector(
    df: DataFrame, wkt_col: str, srid_init: int, srid_dest: int, out: str = "geom"
) -> DataFrame:
    """Parsed, valid and reprojected geometries; rows without a shape are left out."""
    parsed = df.withColumn(out, wkt.parse(wkt_col, srid_init)).filter(F.col(out).isNotNull())
    return parsed.withColumn(out, project.transform_to(out, srid_dest))


def _with_geom(df: DataFrame) -> DataFrame:
    return df if "geom" in df.columns else df.withColumn("geom", F.lit(None).cast(g.GEOMETRY))


def attach_geom_by_key(df: DataFrame, ref: DataFrame, key: str, ref_key: str) -> DataFrame:
    """Missing geometries from the reference row with the same key, compared as text."""
    shapes = ref.select(
        F.col(ref_key).cast("string").alias("_key"), F.col("geom").alias("_geom")
    ).dropDuplicates(["_key"])
    return (
        _with_geom(df)
        .withColumn("_key", F.col(key).cast("string"))
        .join(shapes, "_key", "left")
        .withColumn("geom", F.coalesce("geom", "_geom"))
        .drop("_key", "_geom")
    )


def attach_geom_xy(
    df: DataFrame, x: str, y: str, srid: int | str = 4326, dest: int = 2154
) -> DataFrame:
    """Missing geometries from coordinates; the system is a number or a column name."""
    source = F.col(srid).cast("int") if isinstance(srid, str) else F.lit(srid)
    made = _with_geom(df).withColumn("_p", g.xy_point(F.col(x), F.col(y), source))
    return (
        made.withColumn("_p", project.transform_to("_p", dest))
        .withColumn("geom", F.coalesce("geom", "_p"))
        .drop("_p")
    )


def geom_score(df: DataFrame, geom: str = "geom") -> DataFrame:
    """Share of rows with a geometry."""
    return df.agg(F.avg(F.col(geom).isNotNull().cast("double")).alias("score_geom"))
