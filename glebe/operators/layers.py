"""Layer jobs: a DataFrame with a geometry column in, a DataFrame out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glebe.functions import geometry as g
from glebe.functions import measure as m
from glebe.functions import overlay as o
from glebe.functions import project, wkt

MEASURES = {
    "area": m.area,
    "length": m.length,
    "perimeter": m.perimeter,
    "compactness": m.compactness,
    "centroid": m.centroid,
}


def computed(layer: DataFrame, value: Column, out: str = "geom") -> DataFrame:
    """``layer`` with a costly column that each row computes once.

    A plain column would be written into every filter and measure on it, as Spark pushes filters below it;
    nothing is pushed below ``explode``.
    """
    return layer.withColumn(out, F.explode(F.array(value)))


def layer_from_wkt(df: DataFrame, wkt_col: str, srid: int, out: str = "geom") -> DataFrame:
    """Geometry column from coordinate text of any of the seven usual kinds."""
    return df.withColumn(out, wkt.parse(wkt_col, srid))


def layer_to_wkt(layer: DataFrame, out: str = "wkt", geom: str = "geom") -> DataFrame:
    return layer.withColumn(out, wkt.render(geom))


def layer_from_xy(
    df: DataFrame, x: str, y: str, srid: int | Column = 2154, out: str = "geom"
) -> DataFrame:
    """Point layer from two text or numeric columns."""
    return df.withColumn(out, g.xy_point(F.col(x), F.col(y), srid))


def with_kind(layer: DataFrame, out: str = "kind", geom: str = "geom") -> DataFrame:
    return layer.withColumn(out, o.kind_name(geom))


def keep_kinds(layer: DataFrame, kinds: Sequence[str], geom: str = "geom") -> DataFrame:
    return layer.filter(o.kind_name(geom).isin(list(kinds)))


def assign_srid(layer: DataFrame, srid: int, geom: str = "geom") -> DataFrame:
    """Relabel the coordinate system without moving anything."""
    return layer.withColumn(geom, F.col(geom).withField("srid", F.lit(srid)))


def reproject(layer: DataFrame, dest: int, geom: str = "geom") -> DataFrame:
    """Move coordinates between 4326 and 2154; the same system is left alone."""
    return layer.withColumn(geom, project.transform_to(geom, dest))


def repair(layer: DataFrame, geom: str = "geom", rings: str = "rings") -> DataFrame:
    """Geometry of raw, possibly self-crossing rings by the even-odd rule."""
    return layer.withColumn(geom, wkt.polygon_of_rings(rings, "srid"))


def measure(layer: DataFrame, what: str, out: str | None = None, geom: str = "geom") -> DataFrame:
    return layer.withColumn(out or what, MEASURES[what](geom))


def overlay_intersection(
    pairs: DataFrame, a: str = "geom_a", b: str = "geom_b", out: str = "geom"
) -> DataFrame:
    """Shared part of every joined pair; pairs that only touch keep an empty geometry."""
    return computed(pairs, o.intersection(a, b), out)


def overlay_union(
    pairs: DataFrame, a: str = "geom_a", b: str = "geom_b", out: str = "geom"
) -> DataFrame:
    return computed(pairs, o.union(a, b), out)


def with_distance(
    pairs: DataFrame, a: str = "geom_a", b: str = "geom_b", out: str = "distance"
) -> DataFrame:
    return pairs.withColumn(out, m.distance(a, b))


def erase(
    layer: DataFrame,
    pairs: DataFrame,
    key: str,
    shape: str = "inter_geom",
    shrink_many: float = 0.0,
    geom: str = "geom",
) -> DataFrame:
    """Each geometry minus every shape paired with its key.

    ``shrink_many`` erodes the shapes of a key that has two or more of them.  Equal
    shapes of a key are collapsed before the shuffle.
    """
    # sorted, so that the result does not depend on the order of the shuffle
    shapes = pairs.groupBy(key).agg(F.sort_array(F.collect_set(shape)).alias("_shapes"), F.count("*").alias("_n"))
    joined = layer.join(shapes, key, "left")
    if shrink_many:
        joined = joined.withColumn(
            "_shapes",
            F.when(
                F.col("_n") > 1, F.transform("_shapes", lambda s: o.erode(s, shrink_many))
            ).otherwise(F.col("_shapes")),
        )
    return computed(joined, o.erase_all(geom, "_shapes"), geom).drop("_shapes", "_n")


def dissolve(
    layer: DataFrame, keys: Sequence[str], geom: str = "geom", buckets: int = 64
) -> DataFrame:
    """One geometry per key group.

    Two steps: pieces are united per (key, bucket of the piece), then per key.  Copies
    of a piece share a bucket and vanish in the map-side set, and a group that holds a
    large share of the layer is spread over ``buckets`` tasks before it meets.
    """
    keys = list(keys)
    spread = layer.withColumn("_b", F.pmod(F.xxhash64(geom), F.lit(buckets)))
    first = computed(spread.groupBy(*keys, "_b").agg(F.collect_set(geom).alias("_g")), o.union_of("_g"), "_u")
    met = first.groupBy(*keys).agg(F.collect_list("_u").alias("_g"))
    return computed(met, o.union_of("_g"), geom).drop("_g")


def erode(layer: DataFrame, d: float, geom: str = "geom") -> DataFrame:
    return computed(layer, o.erode(geom, d), geom)


def fill_holes(layer: DataFrame, geom: str = "geom") -> DataFrame:
    return computed(layer, o.fill_holes(geom), geom)


def shared_boundary_length(
    pairs: DataFrame, piece: str, env: str, out: str = "shared_length"
) -> DataFrame:
    return pairs.withColumn(out, m.shared_boundary_length(piece, env))


def explode_polygons(layer: DataFrame, geom: str = "geom") -> DataFrame:
    """One row per connected polygon; other kinds pass through."""
    return layer.withColumn(geom, F.explode(o.polygons_of(geom)))
