"""Joins of layers with features of any size: each feature is covered by the cells of a quadtree.

Cells of level k are squares of side ``tile * 2^k``. A feature starts in the few cells of its own size; a cell that it
fills becomes a rectangle of that level, one that it meets in part is cut into its four quadrants, down to level 0. So
a feature has pieces in proportion to its border over ``tile``, not to its area, no piece is larger than its
cell, and the pieces of a feature do not overlap. Two pieces can share ground only if the cell of one is that of the
other or lies above it: the join is an equi-join of cells with cells and the levels above them. Each pair
of pieces meets once, so nothing has to be made distinct, and sums over a pair's pieces are sums over the pair.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glebe.functions import geometry as g
from glebe.functions import measure as m
from glebe.functions import overlay as o
from glebe.session import cut_lineage

CELL = ("_level", "_cx", "_cy")


def _side(tile: float) -> Column:
    return F.lit(float(tile)) * F.pow(F.lit(2.0), F.col("_level"))


def _clipped(rows: DataFrame, tile: float) -> DataFrame:
    """Each row's geometry cut to its cell, and whether it fills the cell."""
    s, c = _side(tile), F.col("geom")
    x, y = F.col("_cx") * s, F.col("_cy") * s
    cell = g.make("polygon", c.srid, F.lit(None), (x, y, x + s, y + s))
    cut = rows.withColumn("_cell", cell).withColumn("geom", o.intersection("geom", "_cell"))
    size = m.area("geom")
    met = cut.withColumn("_size", size).filter(F.col("_size") > g.MIN_PART)
    full = F.col("_size") >= s * s - g.MIN_PART
    return met.withColumn("_full", full).withColumn("geom", F.when(full, F.col("_cell")).otherwise(F.col("geom"))).drop("_cell", "_size")


def _started(layer: DataFrame, tile: float) -> DataFrame:
    """One row per cell of the feature's own level that its box meets."""
    c = F.col("geom")
    extent = F.greatest(c.xmax - c.xmin, c.ymax - c.ymin)
    level = F.greatest(F.ceil(F.log2(F.greatest(extent / tile, F.lit(1.0))) - 1e-12), F.lit(0)).cast("int")
    rows = layer.filter(c.isNotNull() & extent.isNotNull()).withColumn("_level", level)
    s = _side(tile)
    across = rows.withColumn("_cx", F.explode(F.sequence(F.floor(c.xmin / s), F.floor(c.xmax / s))))
    return across.withColumn("_cy", F.explode(F.sequence(F.floor(c.ymin / s), F.floor(c.ymax / s))))


def quadrants(rows: DataFrame) -> DataFrame:
    bits = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)])
    split = rows.withColumn("_q", F.explode(bits))
    return split.withColumns(
        {"_level": F.col("_level") - 1, "_cx": F.col("_cx") * 2 + F.col("_q.i"), "_cy": F.col("_cy") * 2 + F.col("_q.j")}
    ).drop("_q")


def covered(layer: DataFrame, tile: float = 200.0) -> tuple[DataFrame, list[int]]:
    """The pieces of the polygons in ``geom`` with their cells, and the levels that occur."""
    started = _started(layer, tile)
    top = started.agg(F.max("_level")).first()[0]
    pieces = _clipped(started, tile)
    if not top:
        return pieces.drop("_full"), [0]
    done = []
    for _ in range(top + 1):
        # pieces of one feature are spread over the tasks before they are cut further
        pieces = cut_lineage(pieces.repartition(*CELL))
        ready = F.col("_full") | (F.col("_level") == 0)
        done.append(pieces.filter(ready))
        rest = pieces.filter(~ready)
        if rest.isEmpty():
            break
        pieces = _clipped(quadrants(rest), tile)
    every = reduce(DataFrame.unionByName, done).drop("_full")
    return every, sorted(r[0] for r in every.select("_level").distinct().collect())


def _under(pieces: DataFrame, levels: list[int], own: bool) -> DataFrame:
    """A row per piece and cell at or above it (above it only, unless ``own``) of the given levels."""
    up = [F.lit(k) - F.col("_level") for k in levels]
    cells = F.array(*[
        F.struct(F.lit(k).alias("_level"), F.expr(f"shiftright(_cx, greatest({k} - _level, 0))").alias("_cx"),
                 F.expr(f"shiftright(_cy, greatest({k} - _level, 0))").alias("_cy"), (d >= 0 if own else d > 0).alias("ok"))
        for k, d in zip(levels, up)
    ])
    spread = pieces.withColumn("_at", F.explode(F.filter(cells, lambda c: c["ok"])))
    return spread.withColumns({n: F.col(f"_at.{n}") for n in CELL}).drop("_at")


def cover_join(a: DataFrame, b: DataFrame, tile: float = 200.0) -> DataFrame:
    """Common ground of the polygons of two layers: columns of both and ``geom``, one row per pair of pieces.

    A pair of features has as many rows as pairs of their pieces share ground; these rows do not overlap. Features that
    only touch are no pair.
    """
    clash = (set(a.columns) & set(b.columns)) - {"geom"}
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    left, levels_a = covered(a, tile)
    right, levels_b = covered(b, tile)
    left, right = left.withColumnRenamed("geom", "geom_a"), right.withColumnRenamed("geom", "geom_b")
    pairs = left.join(_under(right, levels_a, own=True), list(CELL))
    if max(levels_b) > min(levels_a):
        pairs = pairs.unionByName(_under(left, levels_b, own=False).join(right, list(CELL)))
    met = pairs.filter(o.boxes_meet("geom_a", "geom_b")).drop(*CELL)
    return met.withColumn("geom", o.intersection("geom_a", "geom_b")).drop("geom_a", "geom_b").filter(m.area("geom") > g.MIN_PART)


def shared_areas(a: DataFrame, b: DataFrame, key_a: str, key_b: str, tile: float = 200.0) -> DataFrame:
    """(key_a, key_b, area): summed over the pieces, so no geometry of a whole feature is ever put together."""
    pairs = cover_join(a.select(key_a, "geom"), b.select(key_b, "geom"), tile)
    return pairs.groupBy(key_a, key_b).agg(F.sum(m.area("geom")).alias("area"))
