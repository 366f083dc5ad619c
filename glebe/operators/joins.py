"""Spatial joins: equi-joins on tile ids, so Spark shuffles, spills and rebalances them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from glebe.functions import geometry as g
from glebe.functions import measure as m
from glebe.functions import overlay as o
from glebe.operators import layers


def _cover(lo: Column, hi: Column, tile: float) -> Column:
    return F.sequence(F.floor(lo / tile), F.floor(hi / tile))


def tiled(layer: DataFrame, tile: float, geom: str) -> DataFrame:
    """One row per tile that the geometry's box meets (NULL and empty geometries drop out)."""
    c = F.col(geom)
    return layer.withColumn("_tx", F.explode(_cover(c.xmin, c.xmax, tile))).withColumn(
        "_ty", F.explode(_cover(c.ymin, c.ymax, tile))
    )


def hot_tiles(a: DataFrame, b: DataFrame, rows: int) -> DataFrame:
    """Tiles where a side holds more than ``rows`` rows, with the pieces to cut each side into."""

    def load(side: DataFrame, name: str) -> DataFrame:
        return side.groupBy("_tx", "_ty").agg(F.count("*").alias(name))

    both = load(a, "na").join(load(b, "nb"), ["_tx", "_ty"])
    return both.filter((F.col("na") > rows) | (F.col("nb") > rows)).select(
        "_tx",
        "_ty",
        F.ceil(F.col("na") / rows).cast("int").alias("_ka"),
        F.ceil(F.col("nb") / rows).cast("int").alias("_kb"),
    )


def _salted(side: DataFrame, hot: DataFrame, own: str, other: str) -> DataFrame:
    """Cut this side of a hot tile by row hash and copy it once per piece of the other side."""
    cut = F.pmod(F.xxhash64(*side.columns), F.coalesce(F.col(f"_k{own}"), F.lit(1)))
    copies = F.sequence(F.lit(0), F.coalesce(F.col(f"_k{other}"), F.lit(1)) - 1)
    return (
        side.join(hot, ["_tx", "_ty"], "left")
        .withColumn(f"_s{own}", cut.cast("int"))
        .withColumn(f"_s{other}", F.explode(copies))
        .drop("_ka", "_kb")
    )


def spatial_join(
    a: DataFrame,
    b: DataFrame,
    predicate: str = "intersects",
    tile: float = 200.0,
    hot_rows: int | None = None,
    extra: Column | None = None,
) -> DataFrame:
    """Inner join of two layers on a spatial predicate.

    Both layers carry their geometry in ``geom``; the result has ``geom_a`` and
    ``geom_b`` and every other column of the two sides (names must differ).  A pair
    met in several tiles is kept in the one holding the lower-left corner of the two
    boxes' intersection, so no ``distinct`` is needed.

    Uneven tiles are left to adaptive skew-join splitting; with ``hot_rows`` the tile
    loads are counted first and every tile above it is cut on both sides, which also
    works where adaptive execution is off.  ``extra`` is one more join condition.
    """
    clash = (set(a.columns) & set(b.columns)) - {"geom"}
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    left = tiled(a.withColumnRenamed("geom", "geom_a"), tile, "geom_a")
    right = tiled(b.withColumnRenamed("geom", "geom_b"), tile, "geom_b")
    keys = ["_tx", "_ty"]
    if hot_rows is not None:
        hot = hot_tiles(left, right, hot_rows)
        left, right = _salted(left, hot, "a", "b"), _salted(right, hot, "b", "a")
        keys += ["_sa", "_sb"]
    ga, gb = F.col("geom_a"), F.col("geom_b")
    home = (F.floor(F.greatest(ga.xmin, gb.xmin) / tile) == F.col("_tx")) & (
        F.floor(F.greatest(ga.ymin, gb.ymin) / tile) == F.col("_ty")
    )
    near = o.boxes_meet("geom_a", "geom_b") & home
    if extra is not None:
        near = near & extra
    pairs = left.join(right, keys).filter(near)
    return pairs.filter(o.PREDICATES[predicate]("geom_a", "geom_b")).drop(*keys)


def overlap_pairs(layer: DataFrame, tile: float = 200.0, hot_rows: int | None = None) -> DataFrame:
    """Unordered pairs of one layer that overlap: ``fid1 < fid2`` with their intersection.

    Equal shapes never overlap each other, so the join runs on distinct shapes and the
    members of each shape are brought back afterwards: a pile of copies costs one row.
    """
    # two independent 64-bit hashes name a shape
    shaped = layer.select(
        "fid", "geom", F.xxhash64("geom").alias("_h"), F.xxhash64(F.lit(1), "geom").alias("_i")
    )
    shapes = shaped.select("_h", "_i", "geom").dropDuplicates(["_h", "_i"])

    def renamed(df: DataFrame, n: int) -> DataFrame:
        return df.withColumnsRenamed({"_h": f"_h{n}", "_i": f"_i{n}", "fid": f"_fid{n}"})

    first_below = (F.col("_h1") < F.col("_h2")) | (
        (F.col("_h1") == F.col("_h2")) & (F.col("_i1") < F.col("_i2"))
    )
    met = spatial_join(
        renamed(shapes, 1), renamed(shapes, 2), "overlaps", tile, hot_rows, extra=first_below
    )
    # a filter on the intersection must not be pushed into the joins and cut every pair again
    met = layers.overlay_intersection(met, out="inter_geom").drop("geom_a", "geom_b")
    members = shaped.select("_h", "_i", "fid")
    return (
        met.join(renamed(members, 1), ["_h1", "_i1"])
        .join(renamed(members, 2), ["_h2", "_i2"])
        .select(
            F.least("_fid1", "_fid2").alias("fid1"),
            F.greatest("_fid1", "_fid2").alias("fid2"),
            "inter_geom",
        )
    )


def overlap_pairs_between(
    new: DataFrame, old: DataFrame, tile: float = 200.0, hot_rows: int | None = None
) -> DataFrame:
    """Overlapping pairs of two layers: ``id1`` of the new one, ``id2`` of the old one."""
    pairs = spatial_join(
        new.select(F.col("fid").alias("id1"), "geom"),
        old.select(F.col("fid").alias("id2"), "geom"),
        "overlaps",
        tile,
        hot_rows,
    )
    return layers.overlay_intersection(pairs, out="inter_geom").select("id1", "id2", "inter_geom")


def mirrored(pairs: DataFrame) -> DataFrame:
    """Both directions of unordered pairs as ``fid``, ``other``."""
    return pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("fid1").alias("fid"), F.col("fid2").alias("other")),
                F.struct(F.col("fid2").alias("fid"), F.col("fid1").alias("other")),
            )
        ).alias("_d"),
        "inter_geom",
    ).select("_d.fid", "_d.other", "inter_geom")


def without_overlap(layer: DataFrame, pairs: DataFrame, key: str = "fid") -> DataFrame:
    """Features that appear in no pair, passed through as ``step = 'Report'``."""
    return layer.join(pairs.select(key).distinct(), key, "left_anti").withColumn(
        "step", F.lit("Report")
    )


def points_in_cells(
    points: DataFrame,
    cells: DataFrame,
    size: float | None = None,
    tile: float = 200.0,
    hot_rows: int | None = None,
) -> DataFrame:
    """Points with every cell they touch; a point on a border belongs to each neighbour.

    With ``size`` the cells are squares on a regular grid and the join key is arithmetic;
    any other cells go through the tile join.
    """
    origin = lattice_origin(cells, size)
    if origin is None:
        return spatial_join(points, cells, "intersects", tile, hot_rows).withColumnRenamed(
            "geom_a", "geom"
        ).drop("geom_b")

    return (
        on_grid(points, size, origin)
        .join(grid_cells(cells, size, origin).drop("geom"), ["_gx", "_gy"])
        .drop("_gx", "_gy")
    )


def lattice_origin(cells: DataFrame, size: float | None) -> tuple[float, float] | None:
    """Where the lattice of squares of side ``size`` starts; None unless every cell is one of its squares."""
    if size is None:
        return None
    box = F.col("geom")
    square = (
        box.parts.isNull() & (box.kind == "polygon") & (box.xmax - box.xmin == size) & (box.ymax - box.ymin == size)
    )
    x, y = (F.pmod(v, F.lit(float(size))) for v in (box.xmin, box.ymin))
    row = cells.agg(
        F.min(x).alias("x"), F.max(x).alias("x_max"), F.min(y).alias("y"), F.max(y).alias("y_max"),
        F.bool_and(F.coalesce(square, F.lit(False))).alias("squares"),
    ).first()
    regular = row["squares"] and row["x"] == row["x_max"] and row["y"] == row["y_max"]
    return (row["x"], row["y"]) if regular else None


def on_grid(points: DataFrame, size: float, origin: tuple[float, float] = (0.0, 0.0)) -> DataFrame:
    """Points with the grid position(s) of the squares they touch."""

    def touched(v: Column) -> Column:
        k = F.floor(v / size)
        return F.when(v == k * size, F.array(k - 1, k)).otherwise(F.array(k))

    return points.withColumn("_gx", F.explode(touched(F.col("geom.xmin") - origin[0]))).withColumn(
        "_gy", F.explode(touched(F.col("geom.ymin") - origin[1]))
    )


def grid_cells(cells: DataFrame, size: float, origin: tuple[float, float] = (0.0, 0.0)) -> DataFrame:
    """Cells with their grid position."""
    return cells.withColumn("_gx", F.round((F.col("geom.xmin") - origin[0]) / size).cast("bigint")).withColumn(
        "_gy", F.round((F.col("geom.ymin") - origin[1]) / size).cast("bigint")
    )


# --------------------------------------------------------------------------- nearest


ZONE = 2  # levels of the pyramid from the finest tiles up to the smallest zones


def _shuffled(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join of two sides that are larger than Spark takes them for.

    Its size estimate does not see that ``explode`` multiplies rows, so it would send them all through the driver.
    """
    return a.hint("merge").join(b.hint("merge"), list(keys))


def knn_join(
    cells: DataFrame,
    points: DataFrame,
    k: int = 8,
    by: Sequence[str] = ("date_result",),
    tile: float = 200.0,
) -> DataFrame:
    """The ``k`` points nearest to each cell centroid, separately for every ``by`` group.

    Tiles form a pyramid (each level twice as wide).  A cell picks the finest level
    whose 3x3 block around the centroid holds ``k`` points, the same for all cells whose
    centroids share a finest tile; the block's far corner then
    bounds the k-th distance.  A zone of cells reads the non-empty tiles within its cells' bounds,
    so a point is sent to a few zones and not to every cell it might serve.  The
    rank limit is applied per map task before the last shuffle, so a tile holding most of the
    points sends ``k`` rows per cell and task, not all of them.

    ``points`` carry ``point_id`` for ties.  Output: cell columns, ``by``, point columns,
    ``distance``, ``rank``.
    """
    by = list(by)
    levels = _pyramid_height(cells, points, tile)
    sites = (
        cells.withColumn("_c", m.centroid("geom"))
        .select(*[c for c in cells.columns if c != "geom"], F.col("_c.x").alias("_cx"), F.col("_c.y").alias("_cy"))
    )
    pts = points.filter(F.col("geom").isNotNull()).withColumn(
        "_tx", F.floor(F.col("geom.xmin") / tile)
    ).withColumn("_ty", F.floor(F.col("geom.ymin") / tile))
    base = pts.groupBy(*by, "_tx", "_ty").agg(F.count("*").alias("_n"))

    level = F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("_l")
    up = F.pow(F.lit(2.0), F.col("_l"))
    parents = base.select("*", level).select(
        *by,
        "_l",
        F.floor(F.col("_tx") / up).alias("_px"),
        F.floor(F.col("_ty") / up).alias("_py"),
        "_tx",
        "_ty",
        "_n",
    )
    counts = parents.groupBy(*by, "_l", "_px", "_py").agg(F.sum("_n").alias("_n"))

    width = F.lit(float(tile)) * up

    def around(name: str, n: int) -> Column:
        return F.explode(F.sequence(F.col(name) - n, F.col(name) + n))

    # points in the 3x3 block around every tile that has any, and the first level with enough for each tile with sites
    blocks = (
        counts.withColumn("_ox", around("_px", 1)).withColumn("_oy", around("_py", 1))
        .groupBy(*by, "_l", "_ox", "_oy").agg(F.sum("_n").alias("_n3"))
        # the top level stands for "all there is" when a group has fewer than k points
        .filter((F.col("_n3") >= k) | (F.col("_l") == levels))
    )
    spots = sites.select("id_cell", "_cx", "_cy").distinct()
    spots = spots.withColumn("_sx", F.floor(F.col("_cx") / tile)).withColumn("_sy", F.floor(F.col("_cy") / tile))
    asked = (
        spots.select("_sx", "_sy").distinct().select("*", level)
        .withColumn("_ox", F.floor(F.col("_sx") / up))
        .withColumn("_oy", F.floor(F.col("_sy") / up))
    )
    chosen = (
        _shuffled(asked, blocks, ["_l", "_ox", "_oy"])
        .groupBy(*by, "_sx", "_sy")
        .agg(F.min(F.struct("_l", "_ox", "_oy", "_n3")).alias("_m"))
        .select(*by, "_sx", "_sy", "_m.*")
    )
    # cells that share a level and a zone are served together: a zone is a tile of that level, or ZONE levels up for fine ones
    zone = F.greatest(F.col("_l"), F.lit(min(ZONE, levels)))
    side = F.pow(F.lit(2.0), F.col("_g"))
    at = ["_g", "_bx", "_by"]
    chosen = (
        chosen.withColumn("_g", zone)
        .withColumn("_bx", F.floor(F.col("_sx") / side))
        .withColumn("_by", F.floor(F.col("_sy") / side))
    )

    def beyond(lo: Column, hi: Column, o: str) -> Column:
        """From a stretch to the far border of the 3x3 block along one axis."""
        return F.greatest(hi - (F.col(o) - 1) * width, (F.col(o) + 2) * width - lo)

    def reach(x0: Column, x1: Column, y0: Column, y1: Column) -> Column:
        # distance to the far corner of the 3x3 block: the k-th neighbour is not beyond it
        far = F.hypot(beyond(x0, x1, "_ox"), beyond(y0, y1, "_oy"))
        return F.when(F.col("_n3") >= k, far).otherwise(F.lit(float("inf")))

    sx, sy = F.col("_sx"), F.col("_sy")
    zones = chosen.withColumn("_r", reach(sx * tile, (sx + 1) * tile, sy * tile, (sy + 1) * tile)).groupBy(*by, *at).agg(
        F.min("_sx").alias("_x0"), F.max("_sx").alias("_x1"), F.min("_sy").alias("_y0"), F.max("_sy").alias("_y1"), F.max("_r").alias("_r")
    )
    # sqrt(8) tile widths of their level at most: three zones to each side
    near = zones.withColumn("_px", around("_bx", 3)).withColumn("_py", around("_by", 3))
    filled = parents.drop("_n").withColumnRenamed("_l", "_g")

    def gap(lo: str, hi: str, t: str) -> Column:
        return F.greatest(F.col(lo) - F.col(t) - 1, F.col(t) - F.col(hi) - 1, F.lit(0)) * tile

    near = (
        _shuffled(near, filled, [*by, "_g", "_px", "_py"])
        .filter(F.hypot(gap("_x0", "_x1", "_tx"), gap("_y0", "_y1", "_ty")) <= F.col("_r"))
        .select(*by, *at, "_tx", "_ty")
    )
    placed = (
        _shuffled(pts.withColumn("_x", F.col("geom.xmin")).withColumn("_y", F.col("geom.ymin")), near, [*by, "_tx", "_ty"])
        .drop("_tx", "_ty")
    )
    cx, cy = F.col("_cx"), F.col("_cy")
    asking = _shuffled(spots, chosen, ["_sx", "_sy"]).withColumn("_r", reach(cx, cx, cy, cy))
    asking = asking.select(*by, *at, "id_cell", "_cx", "_cy", "_r")
    # the join keeps the cells of a zone in memory, its points stream by
    candidates = (
        _shuffled(placed, asking, [*by, *at])
        .withColumn("distance", F.hypot(F.col("_x") - cx, F.col("_y") - cy))
        .filter(F.col("distance") <= F.col("_r"))
        .drop(*at, "_x", "_y", "_cx", "_cy", "_r")
    )
    order = W.partitionBy(*by, "id_cell").orderBy("distance", "point_id")
    ranked = candidates.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(*by, "id_cell", *[c for c in points.columns if c not in by], "distance", "rank")


def _pyramid_height(cells: DataFrame, points: DataFrame, tile: float) -> int:
    """Levels until one tile spans cells and points together."""
    import math

    row = (
        cells.select("geom")
        .unionByName(points.select("geom"))
        .agg(
            F.max(
                F.greatest(
                    F.abs("geom.xmin"), F.abs("geom.ymin"), F.abs("geom.xmax"), F.abs("geom.ymax")
                )
            ).alias("reach")
        )
        .first()
    )
    reach = row["reach"] or tile
    return max(1, math.ceil(math.log2(max(reach / tile, 1.0))) + 1)
