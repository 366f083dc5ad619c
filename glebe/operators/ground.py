"""Ground and length that the pieces of a group cover together, without ever uniting a whole group.

A group with one piece of any size has that piece's size. Of the others, copies are dropped and a group of up to
``most`` pieces is united in its row. A larger one is cut by a quadtree that starts at cells fit for its box and
count: a cell that one piece fills counts as a whole, a cell with few pieces is united, and only crowded cells are
quartered again. So a row holds at most ``most`` pieces, whatever share of the layer the group has, and sizes of
cells add up to the group's. Only a smallest cell that is still crowded (many shapes that cross in one point) is
united by buckets that meet in one row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glebe.functions import geometry as g
from glebe.functions import measure as m
from glebe.functions import overlay as o
from glebe.operators.cover import CELL, quadrants
from glebe.operators.layers import computed, dissolve
from glebe.session import cut_lineage

FINEST = -4  # cells of 2^-4 m are not cut further: smaller ones come near the smallest part that counts


def _matched(rows: DataFrame, groups: DataFrame, by: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Rows of the given groups; NULL is a key like any other."""
    named = groups.select(*[F.col(k).alias(f"_of_{k}") for k in by])
    return rows.join(named, reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in by]), how)


def _united(rows: DataFrame, by: Sequence[str], size) -> DataFrame:
    """Size of the union per group of few pieces."""
    met = rows.groupBy(*by).agg(F.sort_array(F.collect_list("geom")).alias("_g"))
    return computed(met, o.union_of("_g"), "_u").select(*by, size("_u").alias("_size"))


def _rooted(rows: DataFrame, keys: Sequence[str], most: int) -> DataFrame:
    """One row per piece (of lines: per segment) and cell of its group's first level that it meets.

    With pieces spread evenly a cell of that level would hold ``most`` of them. Its side is at least the root mean
    square of the pieces' extents, so there are a few rows per piece on average, however large some are.
    """
    c = F.col("geom")
    segments = F.transform(c.parts, lambda s: g.from_parts("line", c.srid, F.array(s)))
    single = rows.withColumn("geom", F.explode(F.when(c.kind == "line", segments).otherwise(F.array(c))))
    box = [f("geom." + n).alias(f"_{n}") for f, n in ((F.min, "xmin"), (F.min, "ymin"), (F.max, "xmax"), (F.max, "ymax"))]
    own = F.greatest(c.xmax - c.xmin, c.ymax - c.ymin)
    boxes = single.groupBy(*keys).agg(*box, F.count("*").alias("_n"), F.sqrt(F.avg(own * own)).alias("_rms"))
    extent = F.greatest(F.col("_xmax") - F.col("_xmin"), F.col("_ymax") - F.col("_ymin"))
    side = F.least(extent, F.greatest(F.col("_rms"), extent / F.sqrt(F.col("_n") / most)))
    level = F.greatest(F.ceil(F.log2(side)), F.lit(FINEST)).cast("int")
    sized = boxes.select(*[F.col(k).alias(f"_of_{k}") for k in keys], level.alias("_level"))
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    placed = single.join(sized, same).drop(*[f"_of_{k}" for k in keys])
    s = F.pow(F.lit(2.0), F.col("_level"))
    across = placed.withColumn("_cx", F.explode(F.sequence(F.floor(c.xmin / s), F.floor(c.xmax / s))))
    return across.withColumn("_cy", F.explode(F.sequence(F.floor(c.ymin / s), F.floor(c.ymax / s))))


def _clipped(rows: DataFrame, size) -> DataFrame:
    """Pieces cut to their cells, with whether they fill them; a line on a border belongs to the upper cell."""
    s, c = F.pow(F.lit(2.0), F.col("_level")), F.col("geom")
    x, y = F.col("_cx") * s, F.col("_cy") * s
    beyond = (c.kind == "line") & ((c.xmin >= x + s) | (c.ymin >= y + s))
    cell = g.make("polygon", c.srid, F.lit(None), (x, y, x + s, y + s))
    # a row cuts and measures its piece once, whatever is filtered on it
    cut = computed(rows.filter(~beyond).withColumn("_cell", cell), o.intersection("geom", "_cell"))
    met = computed(cut, size("geom"), "_size").filter(F.col("_size") > g.MIN_PART)
    full = (c.kind == "polygon") & (F.col("_size") >= s * s - g.MIN_PART)
    return met.withColumn("_full", full).drop("_cell", "_size")


def _by_cells(rows: DataFrame, keys: Sequence[str], size, most: int) -> list[DataFrame]:
    """Sizes by cell of the groups that are too large for one row."""
    by, whole, few, last = [*keys, *CELL], [], [], []
    pieces = _clipped(_rooted(rows, keys, most), size)
    while True:
        # copies meet in the map-side step, the rest is spread by shape and not by group
        pieces = cut_lineage(pieces.dropDuplicates([*by, "geom"]))
        cells = cut_lineage(pieces.groupBy(*by).agg(F.count("*").alias("_n"), F.max("_full").alias("_whole")))
        side, closed = F.pow(F.lit(2.0), F.col("_level")), F.col("_whole")
        whole.append(cells.filter(closed).select(*keys, (side * side).alias("_size")))
        few.append(_matched(pieces, cells.filter(~closed & (F.col("_n") <= most)), by))
        crowded = cells.filter(~closed & (F.col("_n") > most))
        last.append(_matched(pieces, crowded.filter(F.col("_level") <= FINEST), by))
        crowded = crowded.filter(F.col("_level") > FINEST)
        if crowded.isEmpty():
            break
        pieces = _clipped(quadrants(_matched(pieces, crowded, by)), size)
    whole, few, last = (reduce(DataFrame.unionByName, x) for x in (whole, few, last))
    # the smallest cells: whatever is still crowded there is united by buckets
    least = dissolve(last.select(*by, "geom"), by).select(*keys, size("geom").alias("_size"))
    return [whole, _united(few, by, size).drop(*CELL), least]


def united_size(
    pieces: DataFrame, keys: Sequence[str], what: str = "area", out: str = "inter", most: int = 32
) -> DataFrame:
    """(keys, out): area of polygons or length of lines that the geometries of a group cover together.

    A group of which no piece has a size keeps a row with 0.  Geometries of NULL count nothing.
    """
    keys, size = list(keys), {"area": m.area, "length": m.length}[what]
    if clash := {"geom", "_size", "_n", *CELL} & set(keys):
        raise ValueError(f"keys with a name of the job: {sorted(clash)}")
    sized = pieces.select(*keys, "geom").withColumn("_size", F.coalesce(size("geom"), F.lit(0.0)))
    rows = cut_lineage(sized)
    groups = rows.groupBy(*keys).agg(F.count_if(F.col("_size") > 0).alias("_n"), F.sum("_size").alias("_size"))
    sizes = [groups.filter(F.col("_n") <= 1).select(*keys, "_size")]
    several = groups.filter(F.col("_n") > 1)
    shared = _matched(rows.filter(F.col("_size") > 0).drop("_size"), several, keys)
    shared = cut_lineage(shared.dropDuplicates([*keys, "geom"]))
    counted = shared.groupBy(*keys).agg(F.count("*").alias("_n"))
    crowded = cut_lineage(counted.filter(F.col("_n") > most))
    if crowded.isEmpty():
        sizes.append(_united(shared, keys, size))
    else:
        sizes.append(_united(_matched(shared, crowded, keys, "left_anti"), keys, size))
        sizes += _by_cells(_matched(shared, crowded, keys), keys, size, most)
    every = reduce(DataFrame.unionByName, sizes)
    if len(sizes) > 2:
        every = every.groupBy(*keys).agg(F.sum("_size").alias("_size"))
    return every.withColumnRenamed("_size", out)
