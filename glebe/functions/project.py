"""Longitude/latitude (4326) to and from Lambert-93 metres (2154).

Lambert conformal conic with two standard parallels on the GRS80 ellipsoid, in closed
form; the inverse latitude is a fixed number of fixed-point steps.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from glebe.functions import geometry as g

# fixed values: definition of the projection
SEMI_MAJOR = 6378137.0
INVERSE_FLATTENING = 298.257222101
LATITUDE_ORIGIN = 46.5
LONGITUDE_ORIGIN = 3.0
PARALLEL_1 = 49.0
PARALLEL_2 = 44.0
FALSE_EASTING = 700000.0
FALSE_NORTHING = 6600000.0

INVERSE_STEPS = 6

_flat = 1 / INVERSE_FLATTENING
ECC = math.sqrt(_flat * (2 - _flat))


def _m(lat: float) -> float:
    return math.cos(lat) / math.sqrt(1 - (ECC * math.sin(lat)) ** 2)


def _t(lat: float) -> float:
    s = ECC * math.sin(lat)
    return math.tan(math.pi / 4 - lat / 2) / ((1 - s) / (1 + s)) ** (ECC / 2)


_p1, _p2, _p0 = (math.radians(v) for v in (PARALLEL_1, PARALLEL_2, LATITUDE_ORIGIN))
CONE = (math.log(_m(_p1)) - math.log(_m(_p2))) / (math.log(_t(_p1)) - math.log(_t(_p2)))
SCALE = SEMI_MAJOR * _m(_p1) / (CONE * _t(_p1) ** CONE)
RHO_0 = SCALE * _t(_p0) ** CONE


def to_metres(lon: Column, lat: Column) -> Column:
    def polar(s: Column) -> Column:
        t = F.tan(F.lit(math.pi / 4) - F.radians(lat) / 2) / F.pow(
            (1 - s) / (1 + s), F.lit(ECC / 2)
        )
        rho = SCALE * F.pow(t, F.lit(CONE))
        theta = CONE * F.radians(lon - LONGITUDE_ORIGIN)
        return g.let(
            F.struct(rho.alias("r"), theta.alias("a")),
            lambda v: g.point(
                FALSE_EASTING + v.r * F.sin(v.a), FALSE_NORTHING + RHO_0 - v.r * F.cos(v.a)
            ),
        )

    return g.let(ECC * F.sin(F.radians(lat)), polar)


def to_degrees(x: Column, y: Column) -> Column:
    east, north = x - FALSE_EASTING, RHO_0 - (y - FALSE_NORTHING)

    def latitude(t: Column) -> Column:
        def step(phi: Column, _i: Column) -> Column:
            return g.let(
                ECC * F.sin(phi),
                lambda s: math.pi / 2 - 2 * F.atan(t * F.pow((1 - s) / (1 + s), F.lit(ECC / 2))),
            )

        start = math.pi / 2 - 2 * F.atan(t)
        return F.aggregate(F.sequence(F.lit(1), F.lit(INVERSE_STEPS)), start, step)

    t = F.pow(F.hypot(east, north) / SCALE, F.lit(1 / CONE))
    return g.point(
        F.degrees(F.atan2(east, north) / CONE) + LONGITUDE_ORIGIN, F.degrees(g.let(t, latitude))
    )


@g.by_name
def transform_to(c: Column, dest: int) -> Column:
    """Geometry in the other coordinate system; an unknown system is an error."""
    if dest not in (4326, 2154):
        raise ValueError(f"unknown coordinate system {dest}")
    move = to_metres if dest == 2154 else to_degrees
    source = 4326 if dest == 2154 else 2154
    items = F.when(
        c.parts.isNull() & (c.kind == "point"), F.array(F.array(g.point(c.xmin, c.ymin)))
    ).otherwise(g.rings(c))
    moved = g.from_parts(
        c.kind, F.lit(dest), F.transform(items, lambda r: F.transform(r, lambda p: move(p.x, p.y)))
    )

    def keep_single(v: Column) -> Column:
        parts = F.when(c.parts.isNotNull() | (c.kind != "point"), v.parts)
        return g.make(c.kind, F.lit(dest), parts, (v.xmin, v.ymin, v.xmax, v.ymax))

    unknown = F.raise_error(
        F.concat(F.lit("no transformation from srid "), c.srid.cast("string"))
    ).cast(g.GEOMETRY)
    return (
        F.when(c.isNull(), F.lit(None).cast(g.GEOMETRY))
        .when(c.srid == dest, c)
        .when(c.srid == source, g.let(moved, keep_single))
        .otherwise(unknown)
    )
