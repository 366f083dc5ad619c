"""Geometry columns from and to coordinate text, and repair of raw rings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glebe.functions import geometry as g


def _vertices(text: Column) -> Column:
    def vertex(t: Column) -> Column:
        xy = F.split(F.trim(t), r"\s+")
        return g.point(F.get(xy, F.lit(0)).try_cast("double"), F.get(xy, F.lit(1)).try_cast("double"))

    return F.transform(F.split(text, ","), vertex)


def coordinate_lists(text: Column) -> Column:
    """Innermost coordinate lists: the rings, chains or points of the text."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"\(([^()]+)\)"), F.lit(1)), _vertices)


@g.by_name
def parse(text: Column, srid: int) -> Column:
    """Polygon, line and point text, each single or multi, and linear rings; else NULL."""
    kind = F.upper(F.regexp_extract(text, r"^\s*(?i:srid=\d+;)?\s*([A-Za-z]+)", 1))

    def build(v: Column) -> Column:
        lists = v.lists
        first = F.get(F.get(lists, F.lit(0)), F.lit(0))
        single = g.make("point", F.lit(srid), F.lit(None), (first.x, first.y, first.x, first.y))
        many = g.from_parts(
            "point",
            F.lit(srid),
            F.transform(F.flatten(lists), lambda p: F.array(p)),
        )
        chains = F.flatten(F.transform(lists, _segments))
        return (
            F.when(F.size(lists) < 1, F.lit(None).cast(g.GEOMETRY))
            .when(v.kind.isin("POLYGON", "MULTIPOLYGON"), polygon_of_rings(lists, F.lit(srid)))
            .when(
                v.kind.isin("LINESTRING", "MULTILINESTRING", "LINEARRING"),
                g.from_parts("line", F.lit(srid), chains),
            )
            .when(v.kind == "POINT", single)
            .when(v.kind == "MULTIPOINT", many)
        )

    bound = F.struct(kind.alias("kind"), coordinate_lists(text).alias("lists"))
    return F.when(text.isNotNull(), g.let(bound, build))


def _segments(chain: Column) -> Column:
    ends = F.slice(chain, F.lit(2), F.greatest(F.size(chain) - 1, F.lit(0)))
    starts = F.slice(chain, F.lit(1), F.greatest(F.size(chain) - 1, F.lit(0)))
    return F.filter(
        F.zip_with(starts, ends, lambda p, q: F.array(p, q)), lambda s: s[0] != s[1]
    )


# --------------------------------------------------------------------------- rings to parts


def _oriented(ring: Column) -> Column:
    """Counter-clockwise ring without the closing vertex."""
    open_ring = F.transform(g.edges(ring), lambda e: g.point(e.x1, e.y1))
    return g.let(
        open_ring, lambda r: F.when(g.ring_area(r) < 0, F.reverse(r)).otherwise(r)
    )


def _is_convex(ring: Column) -> Column:
    return F.forall(
        g.half_planes(ring), lambda h: F.forall(ring, lambda p: g.side(h, p) >= -g.SNAP)
    )


def _is_box(ring: Column) -> Column:
    axis = F.forall(g.edges(ring), lambda e: (e.ux == 0) | (e.uy == 0))
    return (F.size(ring) == 4) & axis


def _crossing_heights(es: Column) -> Column:
    """y of every proper crossing of two edges."""

    def cross(e: Column, f: Column) -> Column:
        den = e.ux * f.uy - e.uy * f.ux
        t = ((f.x1 - e.x1) * f.uy - (f.y1 - e.y1) * f.ux) / den
        u = ((f.x1 - e.x1) * e.uy - (f.y1 - e.y1) * e.ux) / den
        inside = (t > g.SNAP) & (t < e.len - g.SNAP) & (u > g.SNAP) & (u < f.len - g.SNAP)
        return F.when(F.abs(den) > 1e-12, F.when(inside, e.y1 + e.uy * t))

    found = F.flatten(F.transform(es, lambda e: F.transform(es, lambda f: cross(e, f))))
    return F.filter(found, lambda y: y.isNotNull())


def slabs(rings: Column) -> Column:
    """Even-odd surface of any rings as trapezoids between consecutive heights."""

    def decompose(es: Column) -> Column:
        heights = F.array_sort(
            F.array_distinct(F.concat(F.transform(es, lambda e: e.y1), _crossing_heights(es)))
        )
        return g.let(heights, lambda ys: F.flatten(F.transform(_steps(ys), lambda b: _slab(es, b))))

    return F.filter(g.let(g.all_edges(rings), decompose), g.has_surface)


def _steps(ys: Column) -> Column:
    upper = F.slice(ys, F.lit(2), F.greatest(F.size(ys) - 1, F.lit(0)))
    lower = F.slice(ys, F.lit(1), F.greatest(F.size(ys) - 1, F.lit(0)))
    bands = F.zip_with(lower, upper, lambda a, b: F.struct(a.alias("lo"), b.alias("hi")))
    return F.filter(bands, lambda b: b.hi - b.lo > g.SNAP)


def _slab(es: Column, band: Column) -> Column:
    spanning = F.filter(
        es,
        lambda e: (F.least(e.y1, e.y2) <= band.lo + g.SNAP)
        & (F.greatest(e.y1, e.y2) >= band.hi - g.SNAP),
    )

    def at(e: Column, y: Column) -> Column:
        return e.x1 + (y - e.y1) * e.ux / e.uy

    cuts = F.array_sort(
        F.transform(
            spanning,
            lambda e: F.struct(
                (at(e, band.lo) + at(e, band.hi)).alias("mid"),
                at(e, band.lo).alias("lo"),
                at(e, band.hi).alias("hi"),
            ),
        )
    )

    def trapezoids(cs: Column) -> Column:
        lefts = F.filter(cs, lambda c, i: i % 2 == 0)
        rights = F.filter(cs, lambda c, i: i % 2 == 1)
        return F.zip_with(
            F.slice(lefts, F.lit(1), F.size(rights)),
            rights,
            lambda a, b: F.array(
                g.point(a.lo, band.lo),
                g.point(b.lo, band.lo),
                g.point(b.hi, band.hi),
                g.point(a.hi, band.hi),
            ),
        )

    return g.let(cuts, trapezoids)


@g.by_name
def polygon_of_rings(rings: Column, srid: Column) -> Column:
    """Polygon of raw rings (outer, holes, self-crossing alike) by the even-odd rule."""

    def build(rs: Column) -> Column:
        def single(r: Column) -> Column:
            xs, ys = F.transform(r, lambda p: p.x), F.transform(r, lambda p: p.y)
            box = (F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))
            return F.when(
                _is_box(r), g.make("polygon", srid, F.lit(None), box)
            ).when(
                (F.size(r) >= 3) & _is_convex(r), g.make("polygon", srid, F.array(r), box)
            )

        simple = F.when(F.size(rs) == 1, g.let(_oriented(F.get(rs, F.lit(0))), single))
        return F.coalesce(simple, g.from_parts("polygon", srid, slabs(rs)))

    return F.when(rings.isNotNull(), g.let(rings, build))


# --------------------------------------------------------------------------- to text


def _xy(p: Column) -> Column:
    return F.concat_ws(" ", p.x.cast("string"), p.y.cast("string"))


def _list_text(vertices: Column) -> Column:
    return F.concat(F.lit("("), F.array_join(F.transform(vertices, _xy), ", "), F.lit(")"))


@g.by_name
def render(c: Column) -> Column:
    """Coordinate text; a polygon of several convex parts lists its parts."""

    def closed(r: Column) -> Column:
        return _list_text(F.concat(r, F.slice(r, 1, 1)))

    def body(rs: Column) -> Column:
        return F.when(
            F.size(rs) == 1, F.concat(F.lit("POLYGON ("), closed(rs[0]), F.lit(")"))
        ).otherwise(
            F.concat(
                F.lit("MULTIPOLYGON ("),
                F.array_join(
                    F.transform(rs, lambda r: F.concat(F.lit("("), closed(r), F.lit(")"))), ", "
                ),
                F.lit(")"),
            )
        )

    lines = F.concat(
        F.lit("MULTILINESTRING ("), F.array_join(F.transform(c.parts, _list_text), ", "), F.lit(")")
    )
    points = F.concat(F.lit("MULTIPOINT "), _list_text(F.flatten(c.parts)))
    return (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(g.is_empty(c), F.concat(F.upper(c.kind), F.lit(" EMPTY")))
        .when(c.kind == "polygon", g.let(g.rings(c), body))
        .when(c.kind == "line", lines)
        .when(c.parts.isNull(), F.concat(F.lit("POINT ("), _xy(g.point(c.xmin, c.ymin)), F.lit(")")))
        .otherwise(points)
    )
