"""Numbers read from a geometry column: area, length, perimeter, centroid, distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glebe.functions import geometry as g


@g.by_name
def area(c: Column) -> Column:
    """Surface; 0 for lines, points and empty polygons, NULL for NULL."""
    box = (c.xmax - c.xmin) * (c.ymax - c.ymin)
    parts = F.aggregate(c.parts, F.lit(0.0), lambda s, r: s + g.ring_area(r))
    return (
        F.when(c.isNull(), F.lit(None).cast("double"))
        .when(c.kind != "polygon", F.lit(0.0))
        .when(c.parts.isNull(), box)
        .otherwise(parts)
    )


@g.by_name
def length(c: Column) -> Column:
    """Length of a line; 0 for other kinds."""
    total = F.aggregate(
        F.transform(c.parts, lambda s: F.coalesce(g.segment_edge(s).len, F.lit(0.0))),
        F.lit(0.0),
        lambda a, x: a + x,
    )
    return (
        F.when(c.isNull(), F.lit(None).cast("double"))
        .when(c.kind != "line", F.lit(0.0))
        .otherwise(total)
    )


@g.by_name
def perimeter(c: Column) -> Column:
    """Outer and hole boundary: all edges less both sides of every shared stretch."""

    def inner(es: Column) -> Column:
        own = F.aggregate(F.transform(es, lambda e: e.len), F.lit(0.0), lambda a, x: a + x)
        shared = F.aggregate(
            F.flatten(F.transform(es, lambda e: g.covered_spans(e, es, False))),
            F.lit(0.0),
            lambda a, s: a + (s.hi - s.lo),
        )
        return own - shared

    box = 2 * ((c.xmax - c.xmin) + (c.ymax - c.ymin))
    return (
        F.when(c.isNull(), F.lit(None).cast("double"))
        .when(c.kind != "polygon", F.lit(0.0))
        .when(c.parts.isNull(), box)
        .otherwise(
            g.let(
                g.parts_as_boxes(c.parts),
                lambda b: F.when(b.isNotNull(), g.boxes_perimeter(b)).otherwise(g.let(g.all_edges(c.parts), inner)),
            )
        )
    )


@g.by_name
def compactness(c: Column) -> Column:
    """Area over perimeter, the sliver test; NULL for an empty outline."""
    return F.try_divide(area(c), perimeter(c))


def _ring_moment(r: Column) -> Column:
    """Area and area-weighted centre of one ring, relative to its first vertex."""

    def body(v: Column) -> Column:
        o = F.get(v, F.lit(0))
        tri = F.zip_with(
            v,
            g.turn(v),
            lambda p, q: F.struct(
                ((p.x - o.x) * (q.y - o.y) - (q.x - o.x) * (p.y - o.y)).alias("w"),
                (p.x - o.x + q.x - o.x).alias("sx"),
                (p.y - o.y + q.y - o.y).alias("sy"),
            ),
        )
        zero = F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))
        return F.aggregate(
            tri,
            zero,
            lambda a, t: F.struct(
                (a.w + t.w / 2).alias("w"),
                (a.mx + t.sx * t.w / 6).alias("mx"),
                (a.my + t.sy * t.w / 6).alias("my"),
            ),
            lambda a: F.struct(
                a.w.alias("w"), (a.mx + o.x * a.w).alias("mx"), (a.my + o.y * a.w).alias("my")
            ),
        )

    return g.let(r, body)


@g.by_name
def centroid(c: Column) -> Column:
    """Centre of mass as ``struct<x, y>``: by area for polygons, by length for lines."""

    def mean(items: Column) -> Column:
        zero = F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))
        return F.aggregate(
            items,
            zero,
            lambda a, m: F.struct(
                (a.w + m.w).alias("w"), (a.mx + m.mx).alias("mx"), (a.my + m.my).alias("my")
            ),
            lambda a: g.point(F.try_divide(a.mx, a.w), F.try_divide(a.my, a.w)),
        )

    def middle(s: Column) -> Column:
        return g.let(
            g.segment_edge(s),
            lambda e: F.struct(
                e.len.alias("w"),
                ((e.x1 + e.x2) / 2 * e.len).alias("mx"),
                ((e.y1 + e.y2) / 2 * e.len).alias("my"),
            ),
        )

    box = g.point((c.xmin + c.xmax) / 2, (c.ymin + c.ymax) / 2)
    return (
        F.when(c.isNull(), F.lit(None).cast(g.POINT))
        .when(c.parts.isNull(), box)
        .when(c.kind == "polygon", mean(F.transform(c.parts, _ring_moment)))
        .when(c.kind == "line", mean(F.transform(c.parts, middle)))
        .otherwise(box)
    )


def _segment_gap(px: Column, py: Column, e: Column) -> Column:
    t = F.greatest(
        F.lit(0.0), F.least(e.len, (px - e.x1) * e.ux + (py - e.y1) * e.uy)
    )
    return g.let(
        t,
        lambda k: F.hypot(px - (e.x1 + e.ux * k), py - (e.y1 + e.uy * k)),
    )


@g.by_name
def distance_to_point(c: Column, px: Column, py: Column) -> Column:
    """Planar distance from a point to a geometry (0 inside a polygon)."""

    def nearest(es: Column) -> Column:
        return F.array_min(F.transform(es, lambda e: _segment_gap(px, py, e)))

    box = F.hypot(
        F.greatest(c.xmin - px, px - c.xmax, F.lit(0.0)),
        F.greatest(c.ymin - py, py - c.ymax, F.lit(0.0)),
    )
    inside = F.exists(
        F.transform(c.parts, g.half_planes),
        lambda hs: F.forall(hs, lambda h: h.nx * px + h.ny * py + h.c >= 0),
    )
    to_points = F.array_min(
        F.transform(F.flatten(c.parts), lambda p: F.hypot(p.x - px, p.y - py))
    )
    return (
        F.when(c.isNull(), F.lit(None).cast("double"))
        .when(c.parts.isNull(), box)
        .when(c.kind == "point", to_points)
        .when(c.kind == "line", nearest(F.transform(c.parts, g.segment_edge)))
        .when(inside, F.lit(0.0))
        .otherwise(nearest(g.all_edges(c.parts)))
    )


@g.by_name
def distance(a: Column, b: Column) -> Column:
    """Planar distance between two geometries, one of which is a single point."""
    a_is_point = (a.kind == "point") & a.parts.isNull()
    return F.when(a_is_point, distance_to_point(b, a.xmin, a.ymin)).otherwise(
        distance_to_point(a, b.xmin, b.ymin)
    )


@g.by_name
def shared_boundary_length(piece: Column, env: Column) -> Column:
    """Length of the outline of ``piece`` lying in the closed polygon ``env``."""

    def body(planes: Column) -> Column:
        per_edge = F.transform(
            g.outline(g.rings(piece)),
            lambda e: g.merged_length(F.transform(planes, lambda hs: g.inside_span(e, hs))),
        )
        return F.aggregate(per_edge, F.lit(0.0), lambda s, x: s + x)

    upright = (piece.kind == "polygon") & piece.parts.isNull() & piece.xmin.isNotNull()
    general = g.let(F.transform(g.rings(env), g.half_planes), body)
    return F.when(
        piece.isNotNull() & env.isNotNull(),
        g.let(
            F.when(upright, g.parts_as_boxes(g.rings(env))),
            lambda b: F.when(b.isNotNull(), g.box_outline_within(piece, b)).otherwise(general),
        ),
    )
