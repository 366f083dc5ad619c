"""Geometry reshaping, parcel cleaning and vintage crossing.

The SQL side rasterises to 5 m squares (every fixture edge is a multiple of 5 m), so the
jobs run without the millimetre gaps.
"""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from checks import register
from checks.indicators import INTER_AREA, NESTED, OVERLAP
from glebe import fixtures as fx
from glebe.functions import geometry as g
from glebe.functions import measure as m
from glebe.functions import overlay as o
from glebe.operators import joins, layers, parcels, vintages
from glebe.session import cut_lineage

TILE = 200.0
BOX = (
    "greatest(a.x0,b.x0) AS ix0, greatest(a.y0,b.y0) AS iy0, least(a.x1,b.x1) AS ix1, least(a.y1,b.y1) AS iy1"
)


def squares(src: str, keys: str, x0="ix0", y0="iy0", x1="ix1", y1="iy1", distinct="") -> str:
    return (
        f"SELECT {distinct} {keys}, sx, sy FROM {src}, unnest(range({x0}//5, {x1}//5)) AS t(sx), unnest(range({y0}//5, {y1}//5)) AS u(sy)"
    )


def border(src: str, keys: str) -> str:
    """Squares outside each side of a rectangle."""
    return f"""SELECT {keys}, ix0//5-1 AS sx, sy FROM {src}, unnest(range(iy0//5, iy1//5)) AS t(sy)
  UNION ALL SELECT {keys}, ix1//5, sy FROM {src}, unnest(range(iy0//5, iy1//5)) AS t(sy)
  UNION ALL SELECT {keys}, sx, iy0//5-1 FROM {src}, unnest(range(ix0//5, ix1//5)) AS t(sx)
  UNION ALL SELECT {keys}, sx, iy1//5 FROM {src}, unnest(range(ix0//5, ix1//5)) AS t(sx)"""


def perimeter(src: str) -> str:
    """Boundary length per fid of a set of squares (fid, sx, sy)."""
    return f"""SELECT s.fid, 5.0*count(*) AS perim FROM (
  SELECT fid, sx+1 AS sx, sy FROM {src} UNION ALL SELECT fid, sx-1, sy FROM {src}
  UNION ALL SELECT fid, sx, sy+1 FROM {src} UNION ALL SELECT fid, sx, sy-1 FROM {src}) s
  ANTI JOIN {src} t ON s.fid=t.fid AND s.sx=t.sx AND s.sy=t.sy GROUP BY s.fid"""


ENV = f"""{fx.ctes('pa')},
ov AS (SELECT a.fid AS fid1, b.fid AS fid2, {BOX} FROM pa a JOIN pa b ON a.fid<b.fid AND {OVERLAP} WHERE NOT ({NESTED})),
each AS (SELECT fid1 AS fid, ix0, iy0, ix1, iy1 FROM ov UNION ALL SELECT fid2, ix0, iy0, ix1, iy1 FROM ov),
csq AS ({squares('each', 'fid', distinct='DISTINCT')}),
psq AS ({squares('(SELECT * FROM pa SEMI JOIN each USING (fid))', 'fid', 'x0', 'y0', 'x1', 'y1')}),
envsq AS (SELECT * FROM psq ANTI JOIN csq USING (fid, sx, sy))"""

DECIDE = f"""{ENV},
pe AS ({border('ov', 'fid1, fid2')}),
len1 AS (SELECT fid1, fid2, 5*count(*) AS l FROM pe JOIN envsq e ON e.fid=fid1 AND e.sx=pe.sx AND e.sy=pe.sy GROUP BY ALL),
len2 AS (SELECT fid1, fid2, 5*count(*) AS l FROM pe JOIN envsq e ON e.fid=fid2 AND e.sx=pe.sx AND e.sy=pe.sy GROUP BY ALL),
env AS (SELECT DISTINCT fid FROM envsq),
dec AS (
  SELECT ov.*, CASE WHEN e1.fid IS NOT NULL AND e2.fid IS NOT NULL AND coalesce(len1.l,0)>coalesce(len2.l,0) THEN fid1 ELSE fid2 END AS choix
  FROM ov LEFT JOIN len1 USING (fid1, fid2) LEFT JOIN len2 USING (fid1, fid2)
    LEFT JOIN env e1 ON e1.fid=fid1 LEFT JOIN env e2 ON e2.fid=fid2),
wonsq AS ({squares('dec', 'choix AS fid', distinct='DISTINCT')}),
builtsq AS (SELECT fid, sx, sy FROM envsq WHERE fid IN (SELECT fid FROM wonsq) UNION SELECT fid, sx, sy FROM wonsq WHERE fid IN (SELECT fid FROM env))"""


def _pairs(spark, sf_dir):
    return cut_lineage(joins.overlap_pairs(fx.parcels_a(spark, sf_dir), TILE))


def _each(pairs):
    return joins.mirrored(pairs).select("fid", "inter_geom")


def _env(spark, sf_dir, pairs, gap=0.0):
    return cut_lineage(
        parcels.minimal_envelope(fx.parcels_a(spark, sf_dir), _each(pairs), "fid", 1.0, gap)
    )


@register(
    "J2_P2_overlap_pairs",
    f"WITH {fx.ctes('pa')} SELECT a.fid AS fid1, b.fid AS fid2, {INTER_AREA} AS area FROM pa a JOIN pa b ON a.fid<b.fid AND {OVERLAP} WHERE NOT ({NESTED})",
)
def overlap_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir).select("fid1", "fid2", m.area("inter_geom").alias("area"))


@register(
    "J3_T2_overlap_pairs_between",
    f"WITH {fx.ctes('pa', 'pb')} SELECT a.fid AS id1, b.fid AS id2, {INTER_AREA} AS area FROM pa a JOIN pb b ON {OVERLAP} WHERE NOT ({NESTED})",
)
def overlap_between(spark, sf_dir):
    pairs = joins.overlap_pairs_between(fx.parcels_a(spark, sf_dir), fx.parcels_b(spark, sf_dir), TILE)
    return pairs.select("id1", "id2", m.area("inter_geom").alias("area"))


@register(
    "J4_P3_report_without_overlap",
    f"WITH {ENV} SELECT fid, 'Report' AS step, CAST(w*h AS DOUBLE) AS area FROM pa ANTI JOIN each USING (fid)",
)
def report(spark, sf_dir):
    out = joins.without_overlap(fx.parcels_a(spark, sf_dir), _each(_pairs(spark, sf_dir)))
    return out.select("fid", "step", m.area("geom").alias("area"))


@register(
    "P4_G15_minimal_envelope",
    f"WITH {ENV}, p AS ({perimeter('envsq')}) SELECT fid, CAST(25*count(*) AS DOUBLE) AS area, CAST(perim AS DOUBLE) AS perimeter FROM envsq JOIN p USING (fid) GROUP BY fid, perim",
)
def envelope(spark, sf_dir):
    env = _env(spark, sf_dir, _pairs(spark, sf_dir))
    return env.select(
        "fid", F.round(m.area("geom"), 6).alias("area"), F.round(m.perimeter("geom"), 6).alias("perimeter")
    )


@register(
    "P5_G20_arbitrate",
    f"WITH {DECIDE} SELECT fid1, fid2, 'No_pbm' AS step, choix FROM dec",
)
def arbitrate(spark, sf_dir):
    pairs = _pairs(spark, sf_dir)
    return parcels.arbitrate(pairs, _env(spark, sf_dir, pairs)).select("fid1", "fid2", "step", "choix")


@register(
    "P5_arbitrate_small_pieces",
    f"WITH {ENV} SELECT fid1, fid2, CASE WHEN (ix1-ix0)*(iy1-iy0)<100 THEN 'Insuff_area' ELSE 'No_pbm' END AS step FROM ov",
)
def arbitrate_small(spark, sf_dir):
    pairs = _pairs(spark, sf_dir)
    return parcels.arbitrate(pairs, _env(spark, sf_dir, pairs), min_area=100).select("fid1", "fid2", "step")


@register(
    "P6_rebuild",
    f"WITH {DECIDE} SELECT fid, CAST(25*count(*) AS DOUBLE) AS area FROM builtsq GROUP BY fid",
)
def rebuild(spark, sf_dir):
    pairs = _pairs(spark, sf_dir)
    env = _env(spark, sf_dir, pairs)
    won = parcels.arbitrate(pairs, env).filter("decided").select(F.col("choix").alias("fid"), "inter_geom")
    out = parcels.rebuild(env, won, "fid", fill=False)
    return out.select("fid", F.round(m.area("geom"), 6).alias("area"))


@register(
    "P1_P7_P8_P9_P10_clean_parcels",
    f"""WITH {DECIDE}, built AS (SELECT fid, 25.0*count(*) AS area FROM builtsq GROUP BY fid)
SELECT fid AS fid1, 'Report' AS step, CAST(w*h AS DOUBLE) AS area FROM pa ANTI JOIN each USING (fid)
UNION ALL SELECT fid, 'reconstruit', CAST(area AS DOUBLE) FROM built
UNION ALL SELECT fid, 'left_min_env', CAST(25*count(*) AS DOUBLE) FROM envsq ANTI JOIN built USING (fid) GROUP BY fid""",
)
def clean(spark, sf_dir):
    out = parcels.clean_parcels(
        fx.parcels_a(spark, sf_dir), TILE, gap_in=0, gap_many=0, gap_out=0, fill=False
    )
    area = out.withColumn("area", m.area("geom"))
    return area.groupBy("fid1", "step").agg(F.round(F.sum("area"), 6).alias("area"))


# ------------------------------------------------------------------ reshaping


@register("P_clean_each_once", "SELECT count(*) > 0 AS cleaned, CAST(0 AS BIGINT) AS n_overlaps FROM orders")
def clean_each_once(spark, sf_dir):
    """Default gaps, holes filled: no two parcels of the result share more than a thousandth of a square metre."""
    out = cut_lineage(parcels.clean_parcels(fx.parcels_a(spark, sf_dir), TILE, each_once=True))
    layer = cut_lineage(out.select(F.monotonically_increasing_id().alias("fid"), "geom"))
    found = joins.overlap_pairs(layer, TILE).filter(m.area("inter_geom") > 1e-3)
    left = found.agg(F.count("*").alias("n_overlaps"))
    return layer.agg((F.count("*") > 0).alias("cleaned")).crossJoin(F.broadcast(left))


@register(
    "G18_P1_P10_erode",
    f"""WITH {DECIDE}, p AS ({perimeter('builtsq')}), q AS (
  SELECT fid, vx, vy, count(*) AS n, bool_or(d=0) AND bool_or(d=3) AND count(*)=2 AS diag1, bool_or(d=1) AND bool_or(d=2) AND count(*)=2 AS diag2 FROM (
    SELECT fid, sx+dx AS vx, sy+dy AS vy, dx*2+dy AS d FROM builtsq, (VALUES (0,0),(0,1),(1,0),(1,1)) v(dx,dy)) GROUP BY ALL),
corners AS (SELECT fid, sum(CASE WHEN n=1 THEN 1 WHEN n=3 THEN -1 WHEN diag1 OR diag2 THEN 2 ELSE 0 END) AS c FROM q GROUP BY fid)
SELECT fid, round(25.0*count(*)-perim*0.5+0.25*c,4)::DOUBLE AS area FROM builtsq JOIN p USING (fid) JOIN corners USING (fid) GROUP BY fid, perim, c""",
)
def erode(spark, sf_dir):
    pairs = _pairs(spark, sf_dir)
    env = _env(spark, sf_dir, pairs)
    won = parcels.arbitrate(pairs, env).filter("decided").select(F.col("choix").alias("fid"), "inter_geom")
    out = layers.erode(parcels.rebuild(env, won, "fid", fill=False), 0.5)
    return out.select("fid", F.round(m.area("geom"), 4).alias("area"))


@register(
    "G19_fill_holes",
    f"""WITH {fx.ctes('pa')} SELECT fid, CASE fid%3 WHEN 0 THEN CAST(w*h AS DOUBLE) WHEN 1 THEN CAST(w*h-10*(h-10) AS DOUBLE) END AS area FROM pa""",
)
def fill_holes(spark, sf_dir):
    """A hole (filled), a notch (kept) or a full cut (two parts: no result)."""
    c, k = F.col("geom"), F.col("fid") % 3
    cut = g.rectangle(
        c.xmin + 10, F.when(k == 0, c.ymin + 10).otherwise(c.ymin), c.xmin + 20,
        F.when(k == 0, c.ymin + 20).when(k == 1, c.ymax - 10).otherwise(c.ymax),
    )
    df = fx.parcels_a(spark, sf_dir).withColumn("cut", cut).withColumn("geom", o.difference("geom", "cut"))
    return layers.fill_holes(df).select("fid", F.round(m.area("geom"), 6).alias("area"))


@register(
    "G21_explode_polygons",
    f"""WITH {fx.ctes('pa', 'pb')} SELECT fid, CASE WHEN (a.x0<b.x1 AND a.x1>b.x0 AND a.y0<=b.y1 AND a.y1>=b.y0) OR (a.x0<=b.x1 AND a.x1>=b.x0 AND a.y0<b.y1 AND a.y1>b.y0) THEN 1 ELSE 2 END::BIGINT AS n
FROM pa a JOIN (SELECT fid, x0+s AS x0, x1+s AS x1, y0, y1 FROM (SELECT *, 10*(fid%8) AS s FROM pb)) b USING (fid)""",
)
def explode_polygons(spark, sf_dir):
    """Union of a parcel with a shifted partner: one polygon if they share a side, else two."""
    c, s = F.col("geom"), 10 * (F.col("fid") % 8)
    old = fx.parcels_b(spark, sf_dir).select(
        "fid", g.rectangle(c.xmin + s, c.ymin, c.xmax + s, c.ymax).alias("geom_b")
    )
    both = fx.parcels_a(spark, sf_dir).withColumnRenamed("geom", "geom_a").join(old, "fid")
    return layers.explode_polygons(layers.overlay_union(both)).groupBy("fid").agg(F.count("*").alias("n"))


@register(
    "G6_T1_repair",
    f"WITH {fx.ctes('pa')} SELECT fid, CAST(w*h AS DOUBLE)/2 AS area, round(CAST(2*w AS DOUBLE)+2*sqrt(w*w+h*h),6) AS perimeter FROM pa",
)
def repair(spark, sf_dir):
    """A bow tie per parcel becomes its two triangles."""
    c = F.col("geom")
    tie = F.array(
        g.point(c.xmin, c.ymin), g.point(c.xmax, c.ymax), g.point(c.xmin, c.ymax), g.point(c.xmax, c.ymin)
    )
    df = fx.parcels_a(spark, sf_dir).withColumn("rings", F.array(tie)).withColumn("srid", F.lit(2154))
    out = layers.repair(df)
    return out.select(
        "fid", F.round(m.area("geom"), 6).alias("area"), F.round(m.perimeter("geom"), 6).alias("perimeter")
    )


# ------------------------------------------------------------------ vintages

CROSS = f"""{fx.ctes('pa', 'pb')},
ov AS (SELECT a.fid AS id1, b.fid AS id2, {BOX} FROM pa a JOIN pb b ON {OVERLAP} WHERE NOT ({NESTED})),
csq1 AS ({squares('ov', 'id1 AS fid', distinct='DISTINCT')}),
csq2 AS ({squares('ov', 'id2 AS fid', distinct='DISTINCT')}),
psq1 AS ({squares('(SELECT * FROM pa WHERE fid IN (SELECT id1 FROM ov))', 'fid', 'x0', 'y0', 'x1', 'y1')}),
psq2 AS ({squares('(SELECT * FROM pb WHERE fid IN (SELECT id2 FROM ov))', 'fid', 'x0', 'y0', 'x1', 'y1')}),
e1 AS (SELECT * FROM psq1 ANTI JOIN csq1 USING (fid, sx, sy)),
e2 AS (SELECT * FROM psq2 ANTI JOIN csq2 USING (fid, sx, sy)),
env1 AS (SELECT fid, 25*count(*) AS area FROM e1 GROUP BY fid),
env2 AS (SELECT fid, 25*count(*) AS area FROM e2 GROUP BY fid),
pe AS ({border('ov', 'id1, id2')}),
len1 AS (SELECT id1, id2, 5*count(*) AS l FROM pe JOIN e1 e ON e.fid=id1 AND e.sx=pe.sx AND e.sy=pe.sy GROUP BY ALL),
len2 AS (SELECT id1, id2, 5*count(*) AS l FROM pe JOIN e2 e ON e.fid=id2 AND e.sx=pe.sx AND e.sy=pe.sy GROUP BY ALL),
near1 AS (SELECT DISTINCT id1, id2 FROM ov JOIN e1 e ON e.fid=id1 AND e.sx BETWEEN ix0//5-1 AND ix1//5 AND e.sy BETWEEN iy0//5-1 AND iy1//5),
near2 AS (SELECT DISTINCT id1, id2 FROM ov JOIN e2 e ON e.fid=id2 AND e.sx BETWEEN ix0//5-1 AND ix1//5 AND e.sy BETWEEN iy0//5-1 AND iy1//5),
cls AS (
  SELECT ov.*, (ix1-ix0)*(iy1-iy0) AS a, v1.fid IS NOT NULL AS has1, v2.fid IS NOT NULL AS has2, coalesce(len1.l,0) AS l1, coalesce(len2.l,0) AS l2,
    n1.id1 IS NOT NULL AS t1, n2.id1 IS NOT NULL AS t2, coalesce(v1.area>150,false) AS large1, coalesce(v2.area>150,false) AS large2
  FROM ov LEFT JOIN len1 USING (id1, id2) LEFT JOIN len2 USING (id1, id2) LEFT JOIN env1 v1 ON v1.fid=ov.id1 LEFT JOIN env2 v2 ON v2.fid=ov.id2
    LEFT JOIN near1 n1 ON n1.id1=ov.id1 AND n1.id2=ov.id2 LEFT JOIN near2 n2 ON n2.id1=ov.id1 AND n2.id2=ov.id2),
step AS (SELECT *, CASE WHEN a<75 OR (has1 AND NOT t1) OR (has2 AND NOT t2) THEN 'Insuff_area' WHEN a>150 THEN 'Suff_area' ELSE 'No_pbm' END AS step FROM cls),
dec AS (SELECT *, CASE WHEN step<>'No_pbm' THEN 'neant' WHEN has1 AND has2 AND l1>l2 THEN 'new' ELSE 'old' END AS choix FROM step)"""

ATTACH = f"""{CROSS},
w1 AS ({squares("(SELECT * FROM dec WHERE choix='new')", 'id1 AS fid', distinct='DISTINCT')}),
w2 AS ({squares("(SELECT * FROM dec WHERE choix='old')", 'id2 AS fid', distinct='DISTINCT')}),
b1 AS (SELECT * FROM w1 WHERE fid IN (SELECT fid FROM env1) UNION SELECT * FROM e1 WHERE fid IN (SELECT fid FROM w1)),
b2 AS (SELECT * FROM w2 WHERE fid IN (SELECT fid FROM env2) UNION SELECT * FROM e2 WHERE fid IN (SELECT fid FROM w2)),
p1 AS (SELECT id1 AS fid, max(id2) AS other, count(*) AS n FROM dec WHERE choix='new' GROUP BY id1),
p2 AS (SELECT id2 AS fid, max(id1) AS other, count(*) AS n FROM dec WHERE choix='old' GROUP BY id2),
att AS (
  SELECT fid AS id1, other AS id2, CASE WHEN n>1 THEN 'Recursiv' ELSE 'No_pbm' END AS detail, 25*count(*) AS area FROM b1 JOIN p1 USING (fid) GROUP BY ALL
  UNION ALL SELECT other, fid, CASE WHEN n>1 THEN 'Recursiv' ELSE 'No_pbm' END, 25*count(*) FROM b2 JOIN p2 USING (fid) GROUP BY fid, other, n)"""

KEPT = """kp AS (SELECT *, min(id2) OVER (PARTITION BY id1)=id2 AS first1, min(id1) OVER (PARTITION BY id2)=id1 AS first2 FROM dec WHERE step='Suff_area'),
kept AS (
  SELECT id1, id2, CASE WHEN large1 AND large2 THEN 'P2-inter_keep' WHEN large1 THEN 'P2-t2_agg' WHEN large2 THEN 'P2-t1_agg' ELSE 'P2-t1-2_agg' END AS detail,
    a + CASE WHEN NOT large1 AND first1 THEN coalesce(v1.area,0) ELSE 0 END + CASE WHEN NOT large2 AND first2 THEN coalesce(v2.area,0) ELSE 0 END AS area
  FROM kp LEFT JOIN env1 v1 ON v1.fid=id1 LEFT JOIN env2 v2 ON v2.fid=id2
  UNION ALL SELECT DISTINCT id1, NULL::BIGINT, 'P2-t1_keep', v1.area FROM kp JOIN env1 v1 ON v1.fid=id1 WHERE large1
  UNION ALL SELECT DISTINCT NULL::BIGINT, id2, 'P2-t2_keep', v2.area FROM kp JOIN env2 v2 ON v2.fid=id2 WHERE large2)"""


class Stages:
    """The crossing of the two fixture vintages up to a stage."""

    def __init__(self, spark, sf_dir):
        self.new, self.old = fx.parcels_a(spark, sf_dir), fx.parcels_b(spark, sf_dir)
        self.pairs = cut_lineage(joins.overlap_pairs_between(self.new, self.old, TILE))

    @functools.cached_property
    def env_new(self):
        own = self.pairs.select(F.col("id1").alias("fid"), "inter_geom")
        return cut_lineage(parcels.minimal_envelope(self.new, own, "fid", 25.0, 0.0))

    @functools.cached_property
    def env_old(self):
        own = self.pairs.select(F.col("id2").alias("fid"), "inter_geom")
        return cut_lineage(parcels.minimal_envelope(self.old, own, "fid", 25.0, 0.0))

    @functools.cached_property
    def decisions(self):
        return cut_lineage(vintages.classify_pairs(self.pairs, self.env_new, self.env_old))


def _area(df, *keys):
    return df.select(*keys, F.round(m.area("geom"), 6).alias("area"))


@register(
    "T3_report_both_sides",
    f"WITH {CROSS} SELECT fid AS id1, NULL::BIGINT AS id2 FROM pa WHERE fid NOT IN (SELECT id1 FROM ov) UNION ALL SELECT NULL, fid FROM pb WHERE fid NOT IN (SELECT id2 FROM ov)",
)
def report_both(spark, sf_dir):
    s = Stages(spark, sf_dir)
    none = F.lit(None).cast("bigint")
    one = joins.without_overlap(s.new, s.pairs.select(F.col("id1").alias("fid")))
    two = joins.without_overlap(s.old, s.pairs.select(F.col("id2").alias("fid")))
    return one.select(F.col("fid").alias("id1"), none.alias("id2")).unionByName(
        two.select(none.alias("id1"), F.col("fid").alias("id2"))
    )


@register(
    "T4_envelopes_both_sides",
    f"WITH {CROSS} SELECT 1 AS side, fid, CAST(area AS DOUBLE) AS area FROM env1 UNION ALL SELECT 2, fid, CAST(area AS DOUBLE) FROM env2",
)
def envelopes(spark, sf_dir):
    s = Stages(spark, sf_dir)
    return _area(s.env_new.withColumn("side", F.lit(1)), "side", "fid").unionByName(
        _area(s.env_old.withColumn("side", F.lit(2)), "side", "fid")
    )


@register("T5_classify_pairs", f"WITH {CROSS} SELECT id1, id2, step, choix FROM dec")
def classify(spark, sf_dir):
    return Stages(spark, sf_dir).decisions.drop("inter_geom")


@register("T6_attach_middle", f"WITH {ATTACH} SELECT id1, id2, detail, CAST(area AS DOUBLE) AS area FROM att")
def attach(spark, sf_dir):
    s = Stages(spark, sf_dir)
    both = vintages.attach_middle(s.decisions, s.env_new, "new", fill=False).unionByName(
        vintages.attach_middle(s.decisions, s.env_old, "old", fill=False)
    )
    return _area(both, "id1", "id2", "detail")


@register("T7_resolve_kept", f"WITH {CROSS}, {KEPT} SELECT id1, id2, detail, CAST(area AS DOUBLE) AS area FROM kept")
def resolve(spark, sf_dir):
    s = Stages(spark, sf_dir)
    return _area(vintages.resolve_kept(s.decisions, s.env_new, s.env_old), "id1", "id2", "detail")


@register(
    "T8_T9_T10_T11_cross_vintages",
    f"""WITH {ATTACH}, {KEPT}
SELECT id1, id2, 'reconstruit' AS step, detail, CAST(area AS DOUBLE) AS area FROM att
UNION ALL SELECT id1, id2, 'reconstruit', detail, CAST(area AS DOUBLE) FROM kept
UNION ALL SELECT fid, NULL, 'Report', 'Report', CAST(w*h AS DOUBLE) FROM pa WHERE fid NOT IN (SELECT id1 FROM ov)
UNION ALL SELECT NULL, fid, 'Report', 'Report', CAST(w*h AS DOUBLE) FROM pb WHERE fid NOT IN (SELECT id2 FROM ov)
UNION ALL SELECT fid, NULL, 'left_min_env', 'left_min_env', CAST(area AS DOUBLE) FROM env1 WHERE fid NOT IN (SELECT fid FROM b1) AND fid NOT IN (SELECT id1 FROM kp)
UNION ALL SELECT NULL, fid, 'left_min_env', 'left_min_env', CAST(area AS DOUBLE) FROM env2 WHERE fid NOT IN (SELECT fid FROM b2) AND fid NOT IN (SELECT id2 FROM kp)""",
)
def cross(spark, sf_dir):
    rules = vintages.CrossRules(final_area=0, final_ratio=0, gap_many=0, gap_out=0, fill=False)
    out = vintages.cross_vintages(fx.parcels_a(spark, sf_dir), fx.parcels_b(spark, sf_dir), rules, TILE)
    # a parcel in several polygons has one row for each; rows of one kind are added up
    return (
        out.withColumn("area", m.area("geom"))
        .groupBy("id1", "id2", "step", "detail")
        .agg(F.round(F.sum("area"), 6).alias("area"))
    )


LINEAGE = """fin AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey%4<>0 THEN o_custkey END AS id1, CASE WHEN o_orderkey%3<>0 THEN o_orderkey%97 END AS id2 FROM orders),
lh AS (SELECT c_custkey AS id, c_custkey*10 AS fid20, CASE WHEN c_custkey%2=0 THEN c_custkey*10+1 END AS fid19 FROM customer),
rh AS (SELECT s_suppkey AS id, s_suppkey*10+2 AS fid18, s_suppkey*10+3 AS fid17 FROM supplier)"""


def _history(spark, sf_dir):
    k, c, s = F.col("o_orderkey"), F.col("c_custkey"), F.col("s_suppkey")
    final = fx.table(spark, sf_dir, "orders").select(
        k.alias("id"), F.when(k % 4 != 0, F.col("o_custkey")).alias("id1"), F.when(k % 3 != 0, k % 97).alias("id2")
    )
    left = fx.table(spark, sf_dir, "customer").select(
        c.alias("id"), (c * 10).alias("fid20"), F.when(c % 2 == 0, c * 10 + 1).alias("fid19")
    )
    right = fx.table(spark, sf_dir, "supplier").select(
        s.alias("id"), (s * 10 + 2).alias("fid18"), (s * 10 + 3).alias("fid17")
    )
    return final, left, right


@register(
    "J13_attach_lineage",
    f"WITH {LINEAGE} SELECT fin.id, id1, id2, fid20, fid19, fid18, fid17 FROM fin LEFT JOIN lh ON id1=lh.id LEFT JOIN rh ON id2=rh.id",
)
def lineage(spark, sf_dir):
    return vintages.attach_lineage(*_history(spark, sf_dir))


@register("J14_lineage_preview", f"WITH {LINEAGE} SELECT fin.id, fid20 FROM fin JOIN lh ON id1=lh.id ORDER BY fin.id")
def preview(spark, sf_dir):
    final, left, _ = _history(spark, sf_dir)
    return vintages.lineage_preview(final, left)
