"""Planar geometry as ordinary Spark columns.

A geometry is one struct column.  Polygons are sets of convex, counter-clockwise,
interior-disjoint rings, which keeps intersection, difference and union inside
Spark's own higher-order functions.  An axis-aligned rectangle (every grid cell,
most tiles) stores its bounding box only: ``parts`` is NULL, so a cell travels as
four doubles and its overlay is plain arithmetic.

* polygon  ``parts`` = convex rings, NULL for a rectangle, empty for no surface
* line     ``parts`` = segments (two vertices each)
* point    ``parts`` = NULL, the box holds the point; a multi-point keeps its points

The expressions name their arguments many times.  Pass column names (add the value
with ``withColumn`` first) or bind an intermediate value with :func:`let`; passing a
long expression would repeat it at every mention.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RING = T.ArrayType(POINT)
PARTS = T.ArrayType(RING)
GEOMETRY = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("srid", T.IntegerType()),
        T.StructField("parts", PARTS),
        T.StructField("xmin", T.DoubleType()),
        T.StructField("ymin", T.DoubleType()),
        T.StructField("xmax", T.DoubleType()),
        T.StructField("ymax", T.DoubleType()),
    ]
)

SNAP = 1e-7  # metres: a vertex this close to a cutting line lies on it
MIN_PART = 1e-6  # square metres: smaller leftovers of a cut carry no surface
SHORT = 1e-5  # metres: the direction of a shorter edge is noise, it bounds nothing
TOUCH = 1e-6  # metres: shortest shared edge that joins two parts


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``.

    The start value of a fold over nothing is handed on as it is; ``transform`` would copy all that it holds.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda v, _: v, body)


def by_name(fn: Callable[..., Column]) -> Callable[..., Column]:
    """Accept column names; the expression of the same names is built once and reused.

    Building a geometry expression takes thousands of driver calls, an unresolved column
    expression does not depend on the plan it is used in.
    """
    built: dict[tuple, Column] = {}

    @functools.wraps(fn)
    def call(*args: Column | str | float | Callable) -> Column:
        columns = [F.col(a) if isinstance(a, str) else a for a in args]
        if any(isinstance(a, Column) for a in args):
            return fn(*columns)
        if args not in built:
            built[args] = fn(*columns)
        return built[args]

    return call


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def no_rings() -> Column:
    return F.array().cast(PARTS)


def no_points() -> Column:
    return F.array().cast(RING)


# --------------------------------------------------------------------------- building


def make(kind: str | Column, srid: Column, parts: Column, box: tuple[Column, ...]) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.struct(
        kind.alias("kind"),
        srid.cast("int").alias("srid"),
        parts.cast(PARTS).alias("parts"),
        *[c.cast("double").alias(n) for c, n in zip(box, ("xmin", "ymin", "xmax", "ymax"))],
    )


def rectangle(x0: Column, y0: Column, x1: Column, y1: Column, srid: int = 2154) -> Column:
    return make("polygon", F.lit(srid), F.lit(None), (x0, y0, x1, y1))


def xy_point(x: Column, y: Column, srid: int | Column = 2154) -> Column:
    """Point from two columns; NULL when either coordinate is missing or not a number."""
    srid = F.lit(srid) if isinstance(srid, int) else srid
    x, y = x.try_cast("double"), y.try_cast("double")
    return F.when(
        x.isNotNull() & y.isNotNull(), make("point", srid, F.lit(None), (x, y, x, y))
    )


def segment(x0: Column, y0: Column, x1: Column, y1: Column, srid: int = 2154) -> Column:
    ring = F.array(point(x0, y0), point(x1, y1))
    return make(
        "line",
        F.lit(srid),
        F.array(ring),
        (F.least(x0, x1), F.least(y0, y1), F.greatest(x0, x1), F.greatest(y0, y1)),
    )


def from_parts(kind: str | Column, srid: Column, parts: Column) -> Column:
    """Geometry of a list of parts; the box is read from the vertices."""

    def build(p: Column) -> Column:
        def boxed(v: Column) -> Column:
            xs = F.transform(v, lambda q: q.x)
            ys = F.transform(v, lambda q: q.y)
            return make(
                kind, srid, p, (F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))
            )

        return let(F.flatten(p), boxed)

    return let(parts, lambda p: F.when(p.isNotNull(), build(p)))


def rings(g: Column) -> Column:
    """Convex rings of a polygon, spelling out the four corners of a rectangle."""
    return F.when(
        g.parts.isNull() & g.xmin.isNotNull(),
        F.array(
            F.array(
                point(g.xmin, g.ymin),
                point(g.xmax, g.ymin),
                point(g.xmax, g.ymax),
                point(g.xmin, g.ymax),
            )
        ),
    ).otherwise(g.parts)


def is_rect(g: Column) -> Column:
    return g.parts.isNull() & (g.kind == "polygon")


def is_empty(g: Column) -> Column:
    return g.xmin.isNull() | F.coalesce(F.size(g.parts) == 0, F.lit(False))


# --------------------------------------------------------------------------- rings


def turn(ring: Column) -> Column:
    """The ring starting at its second vertex."""
    rest = F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0)))
    return F.concat(rest, F.slice(ring, 1, 1))


def ring_area(ring: Column) -> Column:
    """Signed area, measured from the first vertex so that large coordinates keep precision."""

    def body(r: Column) -> Column:
        o = F.get(r, F.lit(0))
        terms = F.zip_with(
            r,
            turn(r),
            lambda p, q: (p.x - o.x) * (q.y - o.y) - (q.x - o.x) * (p.y - o.y),
        )
        return F.aggregate(terms, F.lit(0.0), lambda s, t: s + t) / 2

    return let(ring, body)


def edges(ring: Column) -> Column:
    """Directed edges with unit direction and length; negligible edges are left out."""

    def edge(p: Column, q: Column) -> Column:
        return let(
            F.sqrt((q.x - p.x) * (q.x - p.x) + (q.y - p.y) * (q.y - p.y)),
            lambda n: F.struct(
                p.x.alias("x1"),
                p.y.alias("y1"),
                q.x.alias("x2"),
                q.y.alias("y2"),
                ((q.x - p.x) / n).alias("ux"),
                ((q.y - p.y) / n).alias("uy"),
                n.alias("len"),
            ),
        )

    pairs = F.filter(
        F.zip_with(ring, turn(ring), lambda p, q: F.struct(p.alias("p"), q.alias("q"))),
        lambda e: (F.abs(e.p.x - e.q.x) > SHORT) | (F.abs(e.p.y - e.q.y) > SHORT),
    )
    return F.transform(pairs, lambda e: edge(e.p, e.q))


def all_edges(parts: Column) -> Column:
    return F.flatten(F.transform(parts, edges))


def half_planes(ring: Column) -> Column:
    """Left side of every edge of a counter-clockwise ring as ``nx*x + ny*y + c >= 0``."""
    return F.transform(
        edges(ring),
        lambda e: F.struct(
            (-e.uy).alias("nx"),
            e.ux.alias("ny"),
            (e.uy * e.x1 - e.ux * e.y1).alias("c"),
        ),
    )


def side(h: Column, p: Column) -> Column:
    """Signed distance of a vertex from a cutting line."""
    return h.nx * p.x + h.ny * p.y + h.c


def _measured(ring: Column, h: Column) -> Column:
    return F.transform(
        ring, lambda p: F.struct(p.x.alias("x"), p.y.alias("y"), side(h, p).alias("s"))
    )


def _one_side(v: Column, sign: int) -> Column:
    """Vertices of a measured ring on one side of the line, with the crossing points."""

    def cross(p: Column, q: Column) -> Column:
        f = p.s / (p.s - q.s)
        return F.struct((p.x + (q.x - p.x) * f).alias("x"), (p.y + (q.y - p.y) * f).alias("y"))

    def inner(p: Column) -> Column:
        return p.s > SNAP if sign > 0 else p.s < -SNAP

    def outer(p: Column) -> Column:
        return p.s < -SNAP if sign > 0 else p.s > SNAP

    def keep(p: Column, q: Column) -> Column:
        own = F.struct(p.x.alias("x"), p.y.alias("y"))
        return (
            F.when(outer(p), F.when(inner(q), F.array(cross(p, q))).otherwise(no_points()))
            .when(inner(p) & outer(q), F.array(own, cross(p, q)))
            .otherwise(F.array(own))
        )

    return F.flatten(F.zip_with(v, turn(v), keep))


def _all_in(v: Column) -> Column:
    return F.forall(v, lambda p: p.s >= -SNAP)


def _all_out(v: Column) -> Column:
    return F.forall(v, lambda p: p.s <= SNAP)


def clip(ring: Column, h: Column) -> Column:
    """Part of a convex ring on the inner side of one half-plane."""
    return let(
        _measured(ring, h),
        lambda v: F.when(_all_in(v), ring).when(_all_out(v), no_points()).otherwise(_one_side(v, 1)),
    )


def clip_all(ring: Column, planes: Column) -> Column:
    return F.aggregate(planes, ring, lambda r, h: clip(r, h))


def has_surface(ring: Column) -> Column:
    return (F.size(ring) >= 3) & (ring_area(ring) > MIN_PART)


def peel(ring: Column, planes: Column) -> Column:
    """Convex ring minus a convex ring given by its half-planes: convex pieces."""

    def step(s: Column, h: Column) -> Column:
        def state(rest: Column, out: Column) -> Column:
            return F.struct(rest.alias("rest"), out.alias("out"))

        def split(v: Column) -> Column:
            outside = F.filter(F.array(_one_side(v, -1)), has_surface)
            return (
                F.when(_all_in(v), s)
                .when(_all_out(v), state(no_points(), no_rings()))
                .otherwise(state(_one_side(v, 1), F.concat(s.out, outside)))
            )

        return let(_measured(s.rest, h), split)

    start = F.struct(ring.cast(RING).alias("rest"), no_rings().alias("out"))
    # nothing left inside: the two do not overlap and the ring stays in one piece
    return F.aggregate(
        planes,
        start,
        step,
        lambda s: F.when(has_surface(s.rest), s.out).otherwise(F.array(ring)),
    )


def parts_minus(parts: Column, other: Column) -> Column:
    """Upright rectangles are cut by their corners, all other rings by half-planes."""

    def one(ring: Column, o: Column) -> Column:
        general = peel(ring, F.coalesce(o.planes, half_planes(o.ring)))
        return let(
            ring_as_box(ring), lambda b: F.when(b.isNotNull() & o.box.isNotNull(), _box_minus(ring, b, o.box)).otherwise(general)
        )

    def known(ring: Column) -> Column:
        return let(
            ring_as_box(ring),
            lambda b: F.struct(ring.alias("ring"), b.alias("box"), F.when(b.isNull(), half_planes(ring)).alias("planes")),
        )

    def mixed(v: Column) -> Column:
        return F.aggregate(
            F.transform(v.other, known),
            v.parts,
            lambda acc, o: F.flatten(F.transform(acc, lambda r: one(r, o))),
        )

    def cut(v: Column) -> Column:
        both = F.struct(_framed(v.parts).alias("a"), parts_as_boxes(v.other).alias("b"))
        return let(
            both,
            lambda u: F.when(u.a.isNotNull() & u.b.isNotNull(), _unframed(_framed_minus(u.a, u.b))).otherwise(mixed(v)),
        )

    return let(F.struct(parts.cast(PARTS).alias("parts"), other.alias("other")), cut)


def parts_intersection(a: Column, b: Column) -> Column:
    pieces = F.flatten(
        F.transform(
            F.transform(b, half_planes),
            lambda hs: F.transform(a, lambda r: clip_all(r, hs)),
        )
    )
    return F.filter(pieces, has_surface)


def parts_union(a: Column, b: Column) -> Column:
    return F.concat(a, parts_minus(b, a))


def union_all(groups: Column) -> Column:
    """Disjoint rings covering every ring list of an array of ring lists."""

    def united(v: Column) -> Column:
        boxes = F.aggregate(v.boxes, _framed(no_rings()), lambda acc, p: F.concat(acc, _framed_minus(p, acc)))
        general = F.aggregate(v.groups, no_rings(), lambda acc, p: parts_union(acc, p))
        return F.when(F.forall(v.boxes, lambda b: b.isNotNull()), _unframed(boxes)).otherwise(general)

    return let(
        groups, lambda g: let(F.struct(g.alias("groups"), F.transform(g, _framed).alias("boxes")), united)
    )


# --------------------------------------------------------------------------- upright rectangles


def ring_as_box(ring: Column) -> Column:
    """The corners ``x0, y0, x1, y1`` of an upright rectangle, NULL for any other ring."""
    p, q, r, s = (F.get(ring, F.lit(i)) for i in range(4))
    level = (p.y == q.y) & (q.x == r.x) & (r.y == s.y) & (s.x == p.x)
    steep = (p.x == q.x) & (q.y == r.y) & (r.x == s.x) & (s.y == p.y)
    box = F.struct(
        F.least(p.x, r.x).alias("x0"), F.least(p.y, r.y).alias("y0"), F.greatest(p.x, r.x).alias("x1"), F.greatest(p.y, r.y).alias("y1")
    )
    return F.when((F.size(ring) == 4) & (level | steep), box)


def box_ring(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1))


def parts_as_boxes(parts: Column) -> Column:
    """One box per part if all parts are upright rectangles, else NULL."""
    return let(F.transform(parts, ring_as_box), lambda b: F.when(F.forall(b, lambda x: x.isNotNull()), b))


def _framed(parts: Column) -> Column:
    """Parts with their corners (``x0, y0, x1, y1, ring``) if all are upright rectangles, else NULL."""

    def frame(ring: Column) -> Column:
        return let(
            F.struct(ring_as_box(ring).alias("b"), ring.alias("ring")),
            lambda v: F.when(v.b.isNotNull(), F.struct(v.b.x0.alias("x0"), v.b.y0.alias("y0"), v.b.x1.alias("x1"), v.b.y1.alias("y1"), v.ring.alias("ring"))),
        )

    return let(F.transform(parts, frame), lambda f: F.when(F.forall(f, lambda x: x.isNotNull()), f))


def _unframed(framed: Column) -> Column:
    """Their rings; a piece that was cut has none of its own yet."""
    return F.transform(framed, lambda f: F.coalesce(f.ring, box_ring(f.x0, f.y0, f.x1, f.y1)))


def _framed_minus(framed: Column, boxes: Column) -> Column:
    """``parts_minus`` of upright rectangles that know their corners: a part meets the boxes near it only."""

    def near(a: Column, b: Column) -> Column:
        return (b.x0 - a.x1 < SNAP) & (a.x0 - b.x1 < SNAP) & (b.y0 - a.y1 < SNAP) & (a.y0 - b.y1 < SNAP)

    def piece(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
        return F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"), F.lit(None).cast(RING).alias("ring"))

    def left(a: Column, b: Column) -> Column:
        return F.when(near(a, b), _box_minus(a, a, b, piece)).otherwise(F.array(a))

    def one(a: Column) -> Column:
        return F.aggregate(
            F.filter(boxes, lambda b: near(a, b)),
            F.array(a),
            lambda acc, b: F.flatten(F.transform(acc, lambda p: left(p, b))),
        )

    return F.flatten(F.transform(framed, one))


def _box_minus(ring: Column, a: Column, b: Column, make=box_ring) -> Column:
    """``peel`` of two upright rectangles: below, right, above, left."""

    def cut(i: Column) -> Column:
        def piece(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
            return F.when((x1 - x0) * (y1 - y0) > MIN_PART, make(x0, y0, x1, y1))

        w, h = i.x1 - i.x0, i.y1 - i.y0
        pieces = F.array_compact(F.array(
            piece(a.x0, a.y0, a.x1, i.y0), piece(i.x1, i.y0, a.x1, a.y1), piece(a.x0, i.y1, i.x1, a.y1), piece(a.x0, i.y0, i.x0, i.y1)
        ))
        return F.when((w > 0) & (h > 0) & (w * h > MIN_PART), pieces).otherwise(F.array(ring))

    # a corner this close to the other border lies on it
    inner = F.struct(
        F.when(b.x0 - a.x0 > SNAP, b.x0).otherwise(a.x0).alias("x0"), F.when(b.y0 - a.y0 > SNAP, b.y0).otherwise(a.y0).alias("y0"),
        F.when(a.x1 - b.x1 > SNAP, b.x1).otherwise(a.x1).alias("x1"), F.when(a.y1 - b.y1 > SNAP, b.y1).otherwise(a.y1).alias("y1"),
    )
    return let(inner, cut)


def _lap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return F.least(a1, b1) - F.greatest(a0, b0)


def _boxes_touch(a: Column, b: Column) -> Column:
    """Two upright rectangles share a stretch of edge, one on either side of it."""
    across = (F.abs(a.x1 - b.x0) < TOUCH) | (F.abs(b.x1 - a.x0) < TOUCH)
    along = (F.abs(a.y1 - b.y0) < TOUCH) | (F.abs(b.y1 - a.y0) < TOUCH)
    return (across & (_lap(a.y0, a.y1, b.y0, b.y1) > TOUCH)) | (along & (_lap(a.x0, a.x1, b.x0, b.x1) > TOUCH))


def boxes_perimeter(boxes: Column) -> Column:
    """Outline length of upright rectangles that do not overlap."""

    def shared(at: Column, lap: Column) -> Column:
        return F.when((F.abs(at) < TOUCH) & (lap > TOUCH), lap).otherwise(F.lit(0.0))

    def met(a: Column) -> Column:
        return F.aggregate(
            boxes,
            F.lit(0.0),
            lambda s, b: s + shared(a.x1 - b.x0, _lap(a.y0, a.y1, b.y0, b.y1)) + shared(a.y1 - b.y0, _lap(a.x0, a.x1, b.x0, b.x1)),
        )

    return F.aggregate(boxes, F.lit(0.0), lambda s, a: s + 2 * (a.x1 - a.x0 + a.y1 - a.y0) - 2 * met(a))


def _boxes_outline(boxes: Column) -> Column:
    """``outline`` of upright rectangles, edge by edge against the facing edges."""

    def edge(x: Column, y: Column, ux: int, uy: int, s: Column) -> Column:
        return F.struct(
            (x + ux * s.lo).alias("x1"), (y + uy * s.lo).alias("y1"), (x + ux * s.hi).alias("x2"), (y + uy * s.hi).alias("y2"),
            F.lit(float(ux)).alias("ux"), F.lit(float(uy)).alias("uy"), (s.hi - s.lo).alias("len"),
        )

    def free(at: Column, facing: str, a: tuple[Column, Column], ends: tuple[str, str], back: bool) -> Column:
        """Stretches of an edge, from its start, that no facing edge covers."""

        def span(b: Column) -> Column:
            lo, hi = F.greatest(a[0], b[ends[0]]), F.least(a[1], b[ends[1]])
            first, last = (a[1] - hi, a[1] - lo) if back else (lo - a[0], hi - a[0])
            return F.when((F.abs(b[facing] - at) < TOUCH) & (hi - lo > TOUCH), F.struct(first.alias("lo"), last.alias("hi")))

        return gaps(F.filter(F.transform(boxes, span), lambda s: s.isNotNull()), a[1] - a[0])

    def around(a: Column) -> Column:
        x, y = ("x0", "x1"), ("y0", "y1")
        return F.concat(
            F.transform(free(a.y0, "y1", (a.x0, a.x1), x, False), lambda s: edge(a.x0, a.y0, 1, 0, s)),
            F.transform(free(a.x1, "x0", (a.y0, a.y1), y, False), lambda s: edge(a.x1, a.y0, 0, 1, s)),
            F.transform(free(a.y1, "y0", (a.x0, a.x1), x, True), lambda s: edge(a.x1, a.y1, -1, 0, s)),
            F.transform(free(a.x0, "x1", (a.y0, a.y1), y, True), lambda s: edge(a.x0, a.y1, 0, -1, s)),
        )

    return F.flatten(F.transform(boxes, around))


def box_outline_within(p: Column, boxes: Column) -> Column:
    """Length of the outline of an upright rectangle ``p`` (a geometry) that lies in closed boxes."""

    def side_in(at: Column, a0: Column, a1: Column, low: str, high: str, b0: str, b1: str) -> Column:
        def span(b: Column) -> Column:
            inside = (b[low] - at < SNAP) & (at - b[high] < SNAP)
            return F.when(inside, F.struct(F.greatest(a0, b[b0]).alias("lo"), F.least(a1, b[b1]).alias("hi")))

        return merged_length(F.transform(boxes, span))

    x, y = ("x0", "x1"), ("y0", "y1")
    return (
        side_in(p.ymin, p.xmin, p.xmax, *y, *x) + side_in(p.xmax, p.ymin, p.ymax, *x, *y)
        + side_in(p.ymax, p.xmin, p.xmax, *y, *x) + side_in(p.xmin, p.ymin, p.ymax, *x, *y)
    )


# --------------------------------------------------------------------------- segments


def inside_span(e: Column, planes: Column) -> Column:
    """Parameter interval (metres from the start) of an edge lying in a closed convex ring."""

    def step(s: Column, h: Column) -> Column:
        def cut(d: Column) -> Column:
            d0, d1 = d.d0, d.d1
            at = e.len * d0 / (d0 - d1)
            return (
                F.when(
                    (d0 < 0) & (d1 < 0),
                    F.struct(F.lit(1.0).alias("lo"), F.lit(0.0).alias("hi")),
                )
                .when((d0 < 0) & (d1 == 0), F.struct(e.len.alias("lo"), s.hi.alias("hi")))
                .when((d0 == 0) & (d1 < 0), F.struct(s.lo.alias("lo"), F.lit(0.0).alias("hi")))
                .when(d0 < 0, F.struct(F.greatest(s.lo, at).alias("lo"), s.hi.alias("hi")))
                .when(d1 < 0, F.struct(s.lo.alias("lo"), F.least(s.hi, at).alias("hi")))
                .otherwise(s)
            )

        def snapped(x: Column, y: Column) -> Column:
            return let(
                h.nx * x + h.ny * y + h.c, lambda d: F.when(F.abs(d) < SNAP, 0.0).otherwise(d)
            )

        ends = F.struct(snapped(e.x1, e.y1).alias("d0"), snapped(e.x2, e.y2).alias("d1"))
        return let(ends, cut)

    start = F.struct(F.lit(0.0).alias("lo"), e.len.cast("double").alias("hi"))
    return F.aggregate(planes, start, step)


def merged_length(spans: Column) -> Column:
    """Length covered by a list of intervals."""
    zero = F.struct(F.lit(-1e300).alias("at"), F.lit(0.0).alias("sum"))
    return F.aggregate(
        F.array_sort(F.filter(spans, lambda s: s.hi > s.lo)),
        zero,
        lambda a, s: F.struct(
            F.greatest(a.at, s.hi).alias("at"),
            (a["sum"] + F.greatest(F.lit(0.0), s.hi - F.greatest(a.at, s.lo))).alias("sum"),
        ),
        lambda a: a["sum"],
    )


def gaps(spans: Column, length: Column) -> Column:
    """Intervals of [0, length] that a list of intervals leaves uncovered."""
    none = F.array().cast("array<struct<lo:double,hi:double>>")
    zero = F.struct(F.lit(0.0).alias("at"), none.alias("out"))

    def step(a: Column, s: Column) -> Column:
        hole = F.struct(a.at.alias("lo"), s.lo.alias("hi"))
        return F.struct(
            F.greatest(a.at, s.hi).alias("at"),
            F.when(s.lo - a.at > TOUCH, F.concat(a.out, F.array(hole))).otherwise(a.out).alias("out"),
        )

    return F.aggregate(
        F.array_sort(spans),
        zero,
        step,
        lambda a: F.when(
            length - a.at > TOUCH,
            F.concat(a.out, F.array(F.struct(a.at.alias("lo"), length.alias("hi")))),
        ).otherwise(a.out),
    )


def collinear_span(e: Column, f: Column, same_way: bool | None) -> Column:
    """Interval of edge ``e`` covered by a collinear edge ``f`` (NULL when they are not collinear).

    ``same_way`` False asks for opposite directions (the shared edge of two rings),
    None accepts both (lines).
    """

    def off(x: Column, y: Column) -> Column:
        return F.abs((x - e.x1) * e.uy - (y - e.y1) * e.ux)

    def along(x: Column, y: Column) -> Column:
        return (x - e.x1) * e.ux + (y - e.y1) * e.uy

    on_line = (off(f.x1, f.y1) < TOUCH) & (off(f.x2, f.y2) < TOUCH)
    if same_way is False:
        on_line = on_line & (e.ux * f.ux + e.uy * f.uy < 0)
    a, b = along(f.x1, f.y1), along(f.x2, f.y2)
    return F.when(
        on_line,
        F.struct(
            F.greatest(F.lit(0.0), F.least(a, b)).alias("lo"),
            F.least(e.len, F.greatest(a, b)).alias("hi"),
        ),
    )


def covered_spans(e: Column, others: Column, same_way: bool | None) -> Column:
    spans = F.transform(others, lambda f: collinear_span(e, f, same_way))
    return F.filter(spans, lambda s: s.isNotNull() & (s.hi - s.lo > TOUCH))


def sub_edge(e: Column, s: Column) -> Column:
    return F.struct(
        (e.x1 + e.ux * s.lo).alias("x1"),
        (e.y1 + e.uy * s.lo).alias("y1"),
        (e.x1 + e.ux * s.hi).alias("x2"),
        (e.y1 + e.uy * s.hi).alias("y2"),
        e.ux.alias("ux"),
        e.uy.alias("uy"),
        (s.hi - s.lo).alias("len"),
    )


def outline(parts: Column) -> Column:
    """Directed outer and hole edges: edges of parts less the stretches two parts share."""

    def cut(es: Column) -> Column:
        return F.flatten(
            F.transform(
                es,
                lambda e: F.transform(
                    gaps(covered_spans(e, es, False), e.len), lambda s: sub_edge(e, s)
                ),
            )
        )

    return let(
        parts_as_boxes(parts), lambda b: F.when(b.isNotNull(), _boxes_outline(b)).otherwise(let(all_edges(parts), cut))
    )


def segment_edge(seg: Column) -> Column:
    """Edge struct of a two-vertex line part."""
    return F.get(edges(seg), F.lit(0))


def edge_segment(e: Column) -> Column:
    return F.array(point(e.x1, e.y1), point(e.x2, e.y2))


def lines_minus(segs: Column, others: Column) -> Column:
    """Segments less the stretches that collinear segments of ``others`` cover."""

    def one(seg: Column) -> Column:
        return let(
            segment_edge(seg),
            lambda e: F.transform(
                gaps(covered_spans(e, F.transform(others, segment_edge), None), e.len),
                lambda s: edge_segment(sub_edge(e, s)),
            ),
        )

    return F.flatten(F.transform(segs, one))


def lines_union_all(groups: Column) -> Column:
    return F.aggregate(
        F.flatten(groups),
        no_rings(),
        lambda acc, s: F.concat(acc, lines_minus(F.array(s), acc)),
    )


def lines_in_parts(segs: Column, parts: Column) -> Column:
    """Pieces of segments that lie in a polygon, each stretch once."""

    def one(seg: Column) -> Column:
        def pieces(e: Column) -> Column:
            spans = F.filter(
                F.transform(F.transform(parts, half_planes), lambda hs: inside_span(e, hs)),
                lambda s: s.hi - s.lo > TOUCH,
            )
            # the covered stretches are the gaps of the gaps
            return F.transform(
                gaps(gaps(spans, e.len), e.len), lambda s: edge_segment(sub_edge(e, s))
            )

        return let(segment_edge(seg), pieces)

    return F.flatten(F.transform(segs, one))


# --------------------------------------------------------------------------- connection


def rings_touch(a: Column, b: Column) -> Column:
    """Two rings share a stretch of edge."""

    def shared(e: Column, f: Column) -> Column:
        span = let(collinear_span(e, f, False), lambda s: s.hi - s.lo > TOUCH)
        return F.coalesce(span, F.lit(False))

    meet = let(
        F.struct(ring_box(a).alias("a"), ring_box(b).alias("b")),
        lambda v: (v.a.x0 <= v.b.x1 + TOUCH)
        & (v.b.x0 <= v.a.x1 + TOUCH)
        & (v.a.y0 <= v.b.y1 + TOUCH)
        & (v.b.y0 <= v.a.y1 + TOUCH),
    )
    general = meet & let(
        edges(b), lambda fs: F.exists(edges(a), lambda e: F.exists(fs, lambda f: shared(e, f)))
    )
    return let(
        F.struct(ring_as_box(a).alias("a"), ring_as_box(b).alias("b")),
        lambda v: F.when(v.a.isNotNull() & v.b.isNotNull(), _boxes_touch(v.a, v.b)).otherwise(general),
    )


def ring_box(ring: Column) -> Column:
    xs, ys = F.transform(ring, lambda p: p.x), F.transform(ring, lambda p: p.y)
    return F.struct(
        F.array_min(xs).alias("x0"),
        F.array_min(ys).alias("y0"),
        F.array_max(xs).alias("x1"),
        F.array_max(ys).alias("y1"),
    )


def components(parts: Column) -> Column:
    """Groups of rings connected through shared edges (one group per single polygon)."""
    none = F.array().cast(T.ArrayType(PARTS))

    def step(groups: Column, ring: Column) -> Column:
        marked = F.transform(
            groups,
            lambda g: F.struct(F.exists(g, lambda r: rings_touch(r, ring)).alias("t"), g.alias("g")),
        )
        return let(
            marked,
            lambda m: F.concat(
                F.transform(F.filter(m, lambda k: ~k.t), lambda k: k.g),
                F.array(
                    F.concat(
                        F.flatten(F.transform(F.filter(m, lambda k: k.t), lambda k: k.g)),
                        F.array(ring),
                    )
                ),
            ),
        )

    return F.aggregate(parts, none, step)


def euler_number(parts: Column) -> Column:
    """Vertices - edges + faces of the closed union: pieces minus holes.

    Edges are split where another part's vertex lies on them, so a shared stretch counts
    once; positions are compared on a 0.01 mm lattice.
    """

    def at(x: Column, y: Column) -> Column:
        return F.struct(F.round(x, 5).alias("x"), F.round(y, 5).alias("y"))

    def count(b: Column) -> Column:
        def stretches(e: Column) -> Column:
            inside = F.filter(
                F.transform(
                    b.vs,
                    lambda p: F.when(
                        F.abs((p.x - e.x1) * e.uy - (p.y - e.y1) * e.ux) < 1e-5,
                        (p.x - e.x1) * e.ux + (p.y - e.y1) * e.uy,
                    ),
                ),
                lambda t: t.isNotNull() & (t > 2e-5) & (t < e.len - 2e-5),
            )

            def middles(ts: Column) -> Column:
                ends = F.concat(ts, F.array(e.len))
                starts = F.concat(F.array(F.lit(0.0)), ts)
                return F.zip_with(
                    starts,
                    ends,
                    lambda lo, hi: at(e.x1 + e.ux * (lo + hi) / 2, e.y1 + e.uy * (lo + hi) / 2),
                )

            return let(F.array_sort(inside), middles)

        halves = F.array_distinct(F.flatten(F.transform(b.es, stretches)))
        return F.size(b.vs) - F.size(halves) + F.size(parts)

    vertices = F.array_distinct(F.transform(F.flatten(parts), lambda p: at(p.x, p.y)))
    return let(F.struct(vertices.alias("vs"), all_edges(parts).alias("es")), count)
