"""Predicates and overlays of two geometry columns.

Rectangle with rectangle is decided from the boxes; every other pair goes through
the convex parts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glebe.functions import geometry as g
from glebe.functions import measure as m


@g.by_name
def boxes_meet(a: Column, b: Column) -> Column:
    return (a.xmin <= b.xmax) & (b.xmin <= a.xmax) & (a.ymin <= b.ymax) & (b.ymin <= a.ymax)


def _rect_intersection(a: Column, b: Column) -> Column:
    x0, y0 = F.greatest(a.xmin, b.xmin), F.greatest(a.ymin, b.ymin)
    x1, y1 = F.least(a.xmax, b.xmax), F.least(a.ymax, b.ymax)
    flat = (x1 <= x0) | (y1 <= y0)
    return g.make("polygon", a.srid, F.when(flat, g.no_rings()), (x0, y0, x1, y1))


@g.by_name
def intersection(a: Column, b: Column) -> Column:
    """Shared surface (or stretch of line) of two geometries; empty when they only touch."""
    polygons = g.from_parts("polygon", a.srid, g.parts_intersection(g.rings(a), g.rings(b)))
    # one of the two is a line: its segments, and the rings of the other
    segments = F.when(a.kind == "line", a.parts).otherwise(b.parts)
    surface = F.when(a.kind == "line", g.rings(b)).otherwise(g.rings(a))
    lines = g.let(
        F.struct(segments.alias("segs"), surface.alias("rings")),
        lambda v: g.from_parts("line", a.srid, g.lines_in_parts(v.segs, v.rings)),
    )
    return (
        F.when(a.isNull() | b.isNull(), F.lit(None).cast(g.GEOMETRY))
        .when(a.kind == "point", a)
        .when(b.kind == "point", b)
        .when(g.is_rect(a) & g.is_rect(b), _rect_intersection(a, b))
        .when((a.kind == "line") | (b.kind == "line"), lines)
        .otherwise(polygons)
    )


@g.by_name
def difference(a: Column, b: Column) -> Column:
    """``a`` without ``b``; ``a`` itself when ``b`` is NULL."""
    apart = ~boxes_meet(a, b) | g.is_empty(b)
    return (
        F.when(b.isNull() | apart, a)
        .when(
            a.kind == "polygon",
            g.from_parts("polygon", a.srid, g.parts_minus(g.rings(a), g.rings(b))),
        )
        .otherwise(a)
    )


@g.by_name
def erase_all(a: Column, others: Column) -> Column:
    """``a`` without every geometry of an array."""
    cut = g.parts_minus(g.rings(a), F.flatten(F.transform(others, g.rings)))
    return F.when(F.coalesce(F.size(others), F.lit(0)) <= 0, a).otherwise(
        g.from_parts("polygon", a.srid, cut)
    )


@g.by_name
def union(a: Column, b: Column) -> Column:
    """Both surfaces; a NULL side leaves the other."""
    return (
        F.when(a.isNull(), b)
        .when(b.isNull(), a)
        .when(
            a.kind == "polygon",
            g.from_parts("polygon", a.srid, g.parts_union(g.rings(a), g.rings(b))),
        )
        .when(
            a.kind == "line",
            g.from_parts(
                "line", a.srid, F.concat(a.parts, g.lines_minus(b.parts, a.parts))
            ),
        )
    )


@g.by_name
def union_of(geoms: Column) -> Column:
    """Union of an array of geometries of one kind."""
    first = F.get(geoms, F.lit(0))
    polygons = g.from_parts(
        "polygon", first.srid, g.union_all(F.transform(geoms, lambda x: g.rings(x)))
    )
    lines = g.from_parts(
        "line", first.srid, g.lines_union_all(F.transform(geoms, lambda x: x.parts))
    )
    points = F.array_distinct(
        F.flatten(
            F.transform(
                geoms,
                lambda x: F.coalesce(x.parts, F.array(F.array(g.point(x.xmin, x.ymin)))),
            )
        )
    )
    return (
        F.when(F.size(geoms) == 1, first)
        .when(first.kind == "polygon", polygons)
        .when(first.kind == "line", lines)
        .otherwise(g.from_parts("point", first.srid, points))
    )


# --------------------------------------------------------------------------- predicates


def _convex_items(c: Column) -> Column:
    """Convex pieces of any geometry: rings, segments or single vertices."""
    single = F.array(F.array(g.point(c.xmin, c.ymin)))
    return F.when(
        c.kind == "point",
        F.coalesce(c.parts, single),
    ).otherwise(g.rings(c))


def _separated(a: Column, b: Column) -> Column:
    """Some edge of ``a`` has all of ``b`` strictly outside."""
    return F.exists(
        g.half_planes(a),
        lambda h: F.forall(b, lambda p: h.nx * p.x + h.ny * p.y + h.c < -g.SNAP),
    )


def _items_meet(a: Column, b: Column) -> Column:
    def span(r: Column) -> Column:
        xs, ys = F.transform(r, lambda p: p.x), F.transform(r, lambda p: p.y)
        return F.struct(
            F.array_min(xs).alias("xmin"),
            F.array_max(xs).alias("xmax"),
            F.array_min(ys).alias("ymin"),
            F.array_max(ys).alias("ymax"),
        )

    boxes = g.let(span(a), lambda sa: g.let(span(b), lambda sb: boxes_meet(sa, sb)))
    # the boxes of two upright rectangles are the rectangles
    upright = g.ring_as_box(a).isNotNull() & g.ring_as_box(b).isNotNull()
    return boxes & (upright | (~_separated(a, b) & ~_separated(b, a)))


@g.by_name
def intersects(a: Column, b: Column) -> Column:
    """At least one common point; touching counts."""
    simple_a = a.parts.isNull()
    simple_b = b.parts.isNull()
    general = F.exists(
        _convex_items(a), lambda r: F.exists(_convex_items(b), lambda s: _items_meet(r, s))
    )
    return boxes_meet(a, b) & F.when(simple_a & simple_b, F.lit(True)).otherwise(general)


@g.by_name
def shared_area(a: Column, b: Column) -> Column:
    w = F.least(a.xmax, b.xmax) - F.greatest(a.xmin, b.xmin)
    h = F.least(a.ymax, b.ymax) - F.greatest(a.ymin, b.ymin)
    rect = F.when((w > 0) & (h > 0), w * h).otherwise(F.lit(0.0))
    general = F.aggregate(
        g.parts_intersection(g.rings(a), g.rings(b)),
        F.lit(0.0),
        lambda s, r: s + g.ring_area(r),
    )
    return F.when(g.is_rect(a) & g.is_rect(b), rect).otherwise(general)


@g.by_name
def overlaps(a: Column, b: Column) -> Column:
    """Interiors meet and neither polygon contains the other."""
    least = F.least(m.area(a), m.area(b))
    return boxes_meet(a, b) & g.let(
        shared_area(a, b), lambda s: (s > g.MIN_PART) & (s < least - g.MIN_PART)
    )


@g.by_name
def contains(a: Column, b: Column) -> Column:
    """``b`` lies in ``a``."""
    in_box = (
        (a.xmin <= b.xmin + g.SNAP)
        & (a.ymin <= b.ymin + g.SNAP)
        & (a.xmax >= b.xmax - g.SNAP)
        & (a.ymax >= b.ymax - g.SNAP)
    )
    point_in = intersects(a, b)
    covered = g.let(shared_area(a, b), lambda s: m.area(b) - s <= g.MIN_PART)
    return in_box & F.when(b.kind == "point", point_in).otherwise(covered)


PREDICATES = {"intersects": intersects, "overlaps": overlaps, "contains": contains}


# --------------------------------------------------------------------------- reshaping


@g.by_name
def erode(c: Column, d: float) -> Column:
    """Negative buffer: the surface farther than ``d`` from the outline (mitred corners)."""
    x0, y0, x1, y1 = c.xmin + d, c.ymin + d, c.xmax - d, c.ymax - d
    gone = (x1 <= x0) | (y1 <= y0)
    rect = g.make("polygon", c.srid, F.when(gone, g.no_rings()), (x0, y0, x1, y1))

    def band(e: Column) -> Column:
        ax, ay = e.x1 - e.ux * d, e.y1 - e.uy * d
        bx, by = e.x2 + e.ux * d, e.y2 + e.uy * d
        nx, ny = -e.uy * d, e.ux * d
        return F.array(
            g.point(ax, ay), g.point(bx, by), g.point(bx + nx, by + ny), g.point(ax + nx, ay + ny)
        )

    cut = g.parts_minus(c.parts, F.transform(g.outline(c.parts), band))
    if d == 0:
        return c
    return (
        F.when(c.isNull() | (c.kind != "polygon"), c)
        .when(c.parts.isNull(), rect)
        .otherwise(g.from_parts("polygon", c.srid, cut))
    )


@g.by_name
def fill_holes(c: Column) -> Column:
    """Polygon of the outer ring; NULL when the geometry is not one connected polygon."""
    x0, y0, x1, y1 = c.xmin - 1, c.ymin - 1, c.xmax + 1, c.ymax + 1
    frame = F.array(F.array(g.point(x0, y0), g.point(x1, y0), g.point(x1, y1), g.point(x0, y1)))

    def on_frame(p: Column) -> Column:
        return (p.x <= x0 + 0.5) | (p.x >= x1 - 0.5) | (p.y <= y0 + 0.5) | (p.y >= y1 - 0.5)

    holes = F.flatten(
        F.filter(
            g.components(g.parts_minus(frame, c.parts)),
            lambda group: ~F.exists(group, lambda r: F.exists(r, on_frame)),
        )
    )
    filled = g.let(
        holes,
        lambda h: F.when(F.size(h) == 0, c).otherwise(
            g.from_parts("polygon", c.srid, F.concat(c.parts, h))
        ),
    )
    return (
        F.when(c.isNull() | (c.kind != "polygon"), F.lit(None).cast(g.GEOMETRY))
        .when(c.parts.isNull(), c)
        .when(F.size(c.parts) == 0, F.lit(None).cast(g.GEOMETRY))
        .when(F.size(c.parts) == 1, c)
        .when(F.size(g.components(c.parts)) > 1, F.lit(None).cast(g.GEOMETRY))
        .when(F.size(c.parts) == 2, c)
        # one piece and Euler number one: no hole to look for
        .when(g.euler_number(c.parts) == 1, c)
        .otherwise(filled)
    )


@g.by_name
def polygons_of(c: Column) -> Column:
    """Array with one geometry per connected polygon."""
    groups = F.transform(g.components(c.parts), lambda p: g.from_parts("polygon", c.srid, p))
    return F.when(
        c.parts.isNull() | (c.kind != "polygon") | (F.size(c.parts) == 1), F.array(c)
    ).otherwise(groups)


@g.by_name
def kind_name(c: Column) -> Column:
    """Polygon, MultiPolygon, LineString, MultiLineString, Point, MultiPoint or Empty."""
    many = F.size(c.parts) > 1
    return (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(g.is_empty(c), F.lit("Empty"))
        .when(
            (c.kind == "polygon") & many & (F.size(g.components(c.parts)) > 1),
            F.lit("MultiPolygon"),
        )
        .when(c.kind == "polygon", F.lit("Polygon"))
        .when(c.kind == "line", F.when(_chains(c.parts) > 1, "MultiLineString").otherwise("LineString"))
        .otherwise(F.when(many, "MultiPoint").otherwise("Point"))
    )


def _chains(segs: Column) -> Column:
    """Number of runs of segments that continue each other."""
    starts = F.transform(segs, lambda s: F.get(s, F.lit(0)))
    ends = F.transform(segs, lambda s: F.get(s, F.lit(1)))
    breaks = F.zip_with(
        F.slice(starts, F.lit(2), F.greatest(F.size(segs) - 1, F.lit(0))),
        F.slice(ends, F.lit(1), F.greatest(F.size(segs) - 1, F.lit(0))),
        lambda p, q: F.when((p.x == q.x) & (p.y == q.y), F.lit(0)).otherwise(F.lit(1)),
    )
    return F.aggregate(breaks, F.lit(1), lambda a, b: a + b)
