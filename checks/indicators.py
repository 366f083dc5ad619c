"""Overlay statistics, aggregation modes and point joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import register
from glebe import fixtures as fx
from glebe.functions import geometry as g
from glebe.functions import measure as m
from glebe.operators import ground, joins, layers, modes, stats

TILE = 200.0

STATS_SQL = f"""{fx.ctes('poly', 'cells')},
pieces AS (
  SELECT id_cell, date_result, value_num, value_str, var_area, fid,
    greatest(x0,cx0) AS px0, greatest(y0,cy0) AS py0, least(x1,cx1) AS px1, least(y1,cy1) AS py1
  FROM poly JOIN cells ON x0<=cx1 AND x1>=cx0 AND y0<=cy1 AND y1>=cy0),
sq AS (
  SELECT DISTINCT id_cell, date_result, value_num, value_str, var_area, sx, sy
  FROM pieces, unnest(range(px0//5, px1//5)) AS t(sx), unnest(range(py0//5, py1//5)) AS u(sy)),
areas AS (SELECT id_cell, date_result, value_num, value_str, var_area, 25.0*count(*) AS a FROM sq GROUP BY ALL),
grp AS (SELECT DISTINCT id_cell, date_result, value_num, value_str, var_area FROM pieces),
stats AS (
  SELECT id_cell, date_result, value_num, value_str, CAST(coalesce(a,0) AS DOUBLE) AS inter,
    CAST(coalesce(a,0) AS DOUBLE)/40000 AS cell_prop, CAST(coalesce(a,0) AS DOUBLE)/var_area AS var_prop,
    value_num/var_area AS density, value_num/var_area*CAST(coalesce(a,0) AS DOUBLE) AS cellvalue_density
  FROM grp LEFT JOIN areas USING (id_cell, date_result, value_num, value_str, var_area))"""


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), n) for c, n in digits.items()})


def poly_stats(spark, sf_dir) -> DataFrame:
    return stats.polygon_stats(fx.cells(spark, sf_dir), fx.poly_data(spark, sf_dir), TILE)


RATIOS = dict(inter=6, cell_prop=9, var_prop=9, density=9, cellvalue_density=6)
STAT_COLUMNS = (
    "id_cell, date_result, value_num, value_str, round(inter,6) AS inter, round(cell_prop,9) AS cell_prop,"
    " round(var_prop,9) AS var_prop, round(density,9) AS density, round(cellvalue_density,6) AS cellvalue_density"
)


@register(
    "J1_spatial_join",
    f"""WITH {fx.ctes('pa', 'cells')}
SELECT fid, id_cell FROM pa JOIN cells ON x0<=cx1 AND x1>=cx0 AND y0<=cy1 AND y1>=cy0""",
)
def spatial_join(spark, sf_dir):
    left, right = fx.parcels_a(spark, sf_dir), fx.cells(spark, sf_dir).select("id_cell", "geom")
    return joins.spatial_join(left, right, "intersects", TILE).select("fid", "id_cell")


@register(
    "J1_spatial_join_hot_tiles",
    f"""WITH {fx.ctes('pa', 'pb')}
SELECT a.fid AS id1, b.fid AS id2 FROM pa a JOIN pb b ON a.x0<=b.x1 AND a.x1>=b.x0 AND a.y0<=b.y1 AND a.y1>=b.y0""",
)
def spatial_join_hot(spark, sf_dir):
    left = fx.parcels_a(spark, sf_dir).withColumnRenamed("fid", "id1")
    right = fx.parcels_b(spark, sf_dir).withColumnRenamed("fid", "id2")
    return joins.spatial_join(left, right, "intersects", TILE, hot_rows=25).select("id1", "id2")


@register(
    "G3_kind_filter",
    f"WITH {fx.ctes('pa')} SELECT 'Polygon' AS kind, count(*) AS n FROM pa UNION ALL SELECT 'LineString', count(*) FROM customer UNION ALL SELECT 'Point', count(*) FROM events",
)
def kinds(spark, sf_dir):
    all_layers = (
        fx.parcels_a(spark, sf_dir).select("geom")
        .unionByName(fx.lines(spark, sf_dir).select("geom"))
        .unionByName(fx.points(spark, sf_dir).select("geom"))
    )
    kept = layers.keep_kinds(all_layers, ["Polygon", "LineString", "Point"])
    return layers.with_kind(kept).groupBy("kind").agg(F.count("*").alias("n"))


@register(
    "G2_G4_point_layer",
    f"WITH {fx.ctes('dom')} SELECT event_id AS id, CAST((event_id*7919)%4000 AS DOUBLE) AS x, CAST((event_id*104729)%(40*nr) AS DOUBLE) AS y, 2154 AS srid FROM events, dom",
)
def point_layer(spark, sf_dir):
    rows = fx.domain_rows(spark, sf_dir)
    e = F.col("event_id")
    text = fx.table(spark, sf_dir, "events").select(
        e.alias("id"),
        ((e * 7919) % 4000).cast("string").alias("tx"),
        ((e * 104729) % (40 * rows)).cast("string").alias("ty"),
    )
    layer = layers.assign_srid(layers.layer_from_xy(text, "tx", "ty", 4326), 2154)
    return layer.select(
        "id", F.col("geom.xmin").alias("x"), F.col("geom.ymin").alias("y"), F.col("geom.srid").alias("srid")
    )


@register(
    "G7_G9_G10_G23_measures",
    f"""WITH {fx.ctes('pa')} SELECT fid, CAST(w*h AS DOUBLE) AS area, CAST(2*(w+h) AS DOUBLE) AS perimeter,
  round(CAST(w*h AS DOUBLE)/(2*(w+h)),9) AS compactness, (x0+x1)/2.0::DOUBLE AS cx, (y0+y1)/2.0::DOUBLE AS cy FROM pa""",
)
def measures(spark, sf_dir):
    layer = fx.parcels_a(spark, sf_dir)
    # spelled-out ring, so the general expressions are checked rather than the box arithmetic
    ring = layer.withColumn("parts", g.rings(F.col("geom")))
    layer = ring.withColumn("geom", F.col("geom").withField("parts", F.col("parts")))
    for what in ("area", "perimeter", "compactness", "centroid"):
        layer = layers.measure(layer, what)
    return layer.select(
        "fid",
        "area",
        "perimeter",
        F.round("compactness", 9).alias("compactness"),
        F.round("centroid.x", 6).alias("cx"),
        F.round("centroid.y", 6).alias("cy"),
    )


@register(
    "G8_length",
    f"WITH {fx.ctes('lines')} SELECT value_str, CAST(sum(n) AS DOUBLE) AS total FROM lines GROUP BY value_str",
)
def lengths(spark, sf_dir):
    layer = layers.measure(fx.lines(spark, sf_dir), "length")
    return layer.groupBy("value_str").agg(F.sum("length").alias("total"))


OVERLAP = "a.x0<b.x1 AND a.x1>b.x0 AND a.y0<b.y1 AND a.y1>b.y0"
NESTED = (
    "(a.x0<=b.x0 AND a.x1>=b.x1 AND a.y0<=b.y0 AND a.y1>=b.y1)"
    " OR (b.x0<=a.x0 AND b.x1>=a.x1 AND b.y0<=a.y0 AND b.y1>=a.y1)"
)
INTER_AREA = (
    "CAST((least(a.x1,b.x1)-greatest(a.x0,b.x0))*(least(a.y1,b.y1)-greatest(a.y0,b.y0)) AS DOUBLE)"
)


@register(
    "G12_overlaps",
    f"""WITH {fx.ctes('pa', 'pb')} SELECT a.fid AS id1, b.fid AS id2 FROM pa a JOIN pb b ON {OVERLAP} WHERE NOT ({NESTED})""",
)
def overlaps(spark, sf_dir):
    left = fx.parcels_a(spark, sf_dir).withColumnRenamed("fid", "id1")
    right = fx.parcels_b(spark, sf_dir).withColumnRenamed("fid", "id2")
    return joins.spatial_join(left, right, "overlaps", TILE).select("id1", "id2")


@register(
    "G13_contains",
    f"""WITH {fx.ctes('pa', 'pb')} SELECT a.fid AS id1, b.fid AS id2 FROM pa a JOIN pb b
  ON a.x0<=b.x0 AND a.x1>=b.x1 AND a.y0<=b.y0 AND a.y1>=b.y1""",
)
def contains(spark, sf_dir):
    left = fx.parcels_a(spark, sf_dir).withColumnRenamed("fid", "id1")
    right = fx.parcels_b(spark, sf_dir).withColumnRenamed("fid", "id2")
    return joins.spatial_join(left, right, "contains", TILE).select("id1", "id2")


@register(
    "G14_overlay_intersection",
    f"""WITH {fx.ctes('pa', 'pb')} SELECT a.fid AS id1, b.fid AS id2, {INTER_AREA} AS area FROM pa a JOIN pb b
  ON a.x0<=b.x1 AND a.x1>=b.x0 AND a.y0<=b.y1 AND a.y1>=b.y0""",
)
def overlay_intersection(spark, sf_dir):
    left = fx.parcels_a(spark, sf_dir).withColumnRenamed("fid", "id1")
    right = fx.parcels_b(spark, sf_dir).withColumnRenamed("fid", "id2")
    pairs = joins.spatial_join(left, right, "intersects", TILE)
    return layers.measure(layers.overlay_intersection(pairs), "area").select("id1", "id2", "area")


@register(
    "G16_overlay_union",
    f"""WITH {fx.ctes('pa', 'pb')} SELECT a.fid AS id1, b.fid AS id2, CAST(a.w*a.h+b.w*b.h AS DOUBLE)-{INTER_AREA} AS area,
  CAST(2*(a.w+a.h)+2*(b.w+b.h)-2*((least(a.x1,b.x1)-greatest(a.x0,b.x0))+(least(a.y1,b.y1)-greatest(a.y0,b.y0))) AS DOUBLE) AS perimeter
  FROM pa a JOIN pb b ON {OVERLAP} WHERE NOT ({NESTED})
  -- crossing bars leave more corners but the same formula""",
)
def overlay_union(spark, sf_dir):
    left = fx.parcels_a(spark, sf_dir).withColumnRenamed("fid", "id1")
    right = fx.parcels_b(spark, sf_dir).withColumnRenamed("fid", "id2")
    pairs = layers.overlay_union(joins.spatial_join(left, right, "overlaps", TILE))
    both = layers.measure(layers.measure(pairs, "area"), "perimeter")
    return rounded(both.select("id1", "id2", "area", "perimeter"), area=6, perimeter=6)


@register(
    "G22_distance",
    f"""WITH {fx.ctes('pts', 'cells')} SELECT point_id, id_cell,
  round(sqrt(pow(greatest(cx0-x, x-cx1, 0),2)+pow(greatest(cy0-y, y-cy1, 0),2)),6) AS distance,
  round(sqrt(pow(x-(cx0+100),2)+pow(y-(cy0+100),2)),6) AS to_centre
  FROM pts JOIN cells ON x BETWEEN cx0 AND cx1 AND y BETWEEN cy0 AND cy1""",
)
def distances(spark, sf_dir):
    pts = fx.points(spark, sf_dir).select("point_id", "geom")
    pairs = joins.spatial_join(pts, fx.cells(spark, sf_dir).select("id_cell", "geom"), "intersects", TILE)
    pairs = layers.with_distance(pairs).withColumn("c", m.centroid("geom_b"))
    far = m.distance_to_point("geom_a", F.col("c.x"), F.col("c.y"))
    return pairs.select(
        "point_id", "id_cell", F.round("distance", 6).alias("distance"), F.round(far, 6).alias("to_centre")
    )


@register("I1_polygon_stats", f"WITH {STATS_SQL} SELECT {STAT_COLUMNS} FROM stats")
def polygon_stats(spark, sf_dir):
    return rounded(poly_stats(spark, sf_dir), **RATIOS)


@register(
    "I1b_polygon_stats_per_feature",
    f"""WITH {STATS_SQL}, one AS (
  SELECT DISTINCT id_cell, date_result, value_num, value_str, var_area, p.x0, p.y0, p.x1, p.y1,
    CAST((px1-px0)*(py1-py0) AS DOUBLE) AS a FROM pieces JOIN poly p USING (fid, date_result, value_num, value_str, var_area))
SELECT id_cell, date_result, value_num, value_str, round(a,6) AS inter, round(a/40000,9) AS cell_prop, round(a/var_area,9) AS var_prop,
  round(value_num/var_area,9) AS density, round(value_num/var_area*a,6) AS cellvalue_density FROM one""",
)
def polygon_stats_feature(spark, sf_dir):
    found = stats.polygon_stats(
        fx.cells(spark, sf_dir), fx.poly_data(spark, sf_dir), TILE, dissolve_by="feature"
    )
    return rounded(found, **RATIOS)


LINE_SQL = f"""{fx.ctes('lines', 'cells')},
lp AS (
  SELECT id_cell, date_result, value_num, value_str, n, c, x0, y0, x1, y1, greatest(x0,cx0) AS px0, greatest(y0,cy0) AS py0, least(x1,cx1) AS px1, least(y1,cy1) AS py1
  FROM lines JOIN cells ON x0<=cx1 AND x1>=cx0 AND y0<=cy1 AND y1>=cy0),
lsq AS (
  SELECT DISTINCT id_cell, date_result, value_num, value_str, n, y0 AS at, sx AS s, 'h' AS o FROM lp, unnest(range(px0//5, px1//5)) AS t(sx) WHERE py0=py1 AND c%2=0
  UNION ALL
  SELECT DISTINCT id_cell, date_result, value_num, value_str, n, x0, sy, 'v' FROM lp, unnest(range(py0//5, py1//5)) AS t(sy) WHERE px0=px1 AND c%2=1),
ll AS (SELECT id_cell, date_result, value_num, value_str, n, 5.0*count(*) AS len FROM lsq GROUP BY ALL),
lg AS (SELECT DISTINCT id_cell, date_result, value_num, value_str, n FROM lp),
li AS (SELECT id_cell, date_result, value_num, value_str, n, CAST(coalesce(len,0) AS DOUBLE) AS inter FROM lg LEFT JOIN ll USING (id_cell, date_result, value_num, value_str, n)),
lt AS (SELECT id_cell, date_result, sum(inter) AS total FROM li GROUP BY ALL HAVING sum(inter)<>0),
lstats AS (
  SELECT id_cell, date_result, value_num, value_str, inter, inter/total AS cell_prop, inter/n AS var_prop,
    value_num/n AS density, value_num/n*inter AS cellvalue_density FROM li JOIN lt USING (id_cell, date_result))"""


def line_stats_of(spark, sf_dir, how="value"):
    return stats.line_stats(fx.cells(spark, sf_dir), fx.lines(spark, sf_dir), TILE, how)


@register("I2_line_stats", f"WITH {LINE_SQL} SELECT {STAT_COLUMNS} FROM lstats")
def line_stats(spark, sf_dir):
    return rounded(line_stats_of(spark, sf_dir), **RATIOS)


@register(
    "I2b_line_stats_per_feature",
    f"""WITH {LINE_SQL}, f AS (
  SELECT DISTINCT id_cell, date_result, value_num, value_str, n, x0, y0, x1, y1, CAST((px1-px0)+(py1-py0) AS DOUBLE) AS inter FROM lp),
ft AS (SELECT id_cell, date_result, sum(inter) AS total FROM f GROUP BY ALL HAVING sum(inter)<>0)
SELECT id_cell, date_result, value_num, value_str, round(inter,6) AS inter, round(inter/total,9) AS cell_prop, round(inter/n,9) AS var_prop,
  round(value_num/n,9) AS density, round(value_num/n*inter,6) AS cellvalue_density FROM f JOIN ft USING (id_cell, date_result)""",
)
def line_stats_feature(spark, sf_dir):
    return rounded(line_stats_of(spark, sf_dir, "feature"), **RATIOS)


# every third order lies in one group, the others in that of their priority
PLOTS = """plots AS (
  SELECT CASE WHEN o_orderkey%3=0 THEN 'every third' ELSE o_orderpriority END AS plot_group,
    o_orderkey%613 AS x, (o_orderkey//7)%389 AS y, 1+o_custkey%4 AS w, 1+o_orderkey%5 AS h FROM orders)"""


def plots(spark, sf_dir, shape) -> DataFrame:
    key, s = F.col("o_orderkey"), {}
    s["x"], s["y"] = key % 613, F.floor(key / 7) % 389
    s["w"], s["h"] = 1 + F.col("o_custkey") % 4, 1 + key % 5
    named = F.when(key % 3 == 0, "every third").otherwise(F.col("o_orderpriority"))
    rows = fx.table(spark, sf_dir, "orders").select(named.alias("plot_group"), *[v.alias(n) for n, v in s.items()])
    return rows.select("plot_group", shape(F.col("x"), F.col("y"), F.col("x") + F.col("w"), F.col("y") + F.col("h")).alias("geom"))


@register(
    "G17_I1_ground_of_large_groups",
    f"""WITH {PLOTS}, squares AS (
  SELECT DISTINCT plot_group, sx, sy FROM plots, unnest(range(x, x+w)) AS t(sx), unnest(range(y, y+h)) AS u(sy))
SELECT plot_group, CAST(count(*) AS DOUBLE) AS ground FROM squares GROUP BY plot_group""",
)
def ground_of_large_groups(spark, sf_dir):
    found = ground.united_size(plots(spark, sf_dir, g.rectangle), ["plot_group"], "area", "ground")
    return rounded(found, ground=6)


@register(
    "G17_I2_length_of_large_groups",
    f"""WITH {PLOTS}, stretches AS (SELECT DISTINCT plot_group, sx, y FROM plots, unnest(range(x, x+w)) AS t(sx))
SELECT plot_group, CAST(count(*) AS DOUBLE) AS length FROM stretches GROUP BY plot_group""",
)
def length_of_large_groups(spark, sf_dir):
    level = plots(spark, sf_dir, lambda x0, y0, x1, y1: g.segment(x0, y0, x1, y0))
    return rounded(ground.united_size(level, ["plot_group"], "length", "length"), length=6)


# ------------------------------------------------------------------ aggregation modes

PLAIN = (
    "CASE WHEN {0}=floor({0}) THEN CAST(CAST({0} AS BIGINT) AS VARCHAR) ELSE CAST({0} AS VARCHAR) END"
)
PAIRS = "id_cell, date_result"
R4 = "coalesce(CAST(round({0},4) AS VARCHAR),'')"
PLUS = (
    "'{\"avg_value\":\"'||" + R4.format("avg(value_num)")
    + "||'\",\"min_value\":\"'||" + R4.format("min(value_num)")
    + "||'\",\"max_value\":\"'||" + R4.format("max(value_num)")
    + "||'\",\"stddev_value\":\"'||" + R4.format("stddev_samp(value_num)")
    + "||'\",\"median_value\":\"'||" + R4.format("median(value_num)")
    + "||'\",\"count\":\"'||CAST(count(value_num) AS VARCHAR)||'\"}'"
)


def _list(item: str) -> str:
    return f"'{{'||string_agg(DISTINCT {item}, ',' ORDER BY {item})||'}}'"


NUM = {
    "A1_intersect": ("intersect", "sum(inter)", 6),
    "A2_intersect_1000": ("intersect/1000", "sum(inter)/1000", 9),
    "A3_prop_surf": ("prop_surf", "sum(cell_prop)", 9),
    "A7_md_prop": ("md_prop", "sum(value_num*cell_prop)", 9),
    "A8_md_prop_norm": (
        "md_prop_norm",
        "CASE WHEN sum(cell_prop)<>0 THEN sum(value_num*cell_prop)/sum(cell_prop) END",
        9,
    ),
    "A9_tot_dens": ("tot_dens", "sum(cellvalue_density)", 6),
    "A10_val_sum": ("val_sum", "sum(value_num)", 6),
    "A11_val_min": ("val_min", "min(value_num)", 6),
    "A12_val_max": ("val_max", "max(value_num)", 6),
    "A13_val_avg": ("val_avg", "avg(value_num)", 9),
    "A14_val_stddev": ("val_stddev", "stddev_samp(value_num)", 6),
    "A15_val_median": ("val_median", "median(value_num)", 6),
    "A18_ct_elt": ("ct_elt", "CAST(count(*) AS DOUBLE)", 0),
    "A19_ct_elt_num": ("ct_elt_num", "CAST(count(DISTINCT value_num) AS DOUBLE)", 0),
    "A20_ct_elt_str": ("ct_elt_str", "CAST(count(DISTINCT value_str) AS DOUBLE)", 0),
}


def _num_query(mode: str, digits: int):
    def run(spark, sf_dir):
        out = modes.areal_aggregate(poly_stats(spark, sf_dir), num_mode=mode)
        return out.select("id_cell", "date_result", F.round("value_num", digits).alias("value_num"))

    return run


for _name, (_mode, _sql, _digits) in NUM.items():
    register(
        _name,
        f"WITH {STATS_SQL} SELECT {PAIRS}, round({_sql},{_digits}) AS value_num FROM stats GROUP BY ALL",
    )(_num_query(_mode, _digits))


@register(
    "A4_prop_len",
    f"WITH {LINE_SQL} SELECT {PAIRS}, round(sum(cell_prop),9) AS value_num FROM lstats GROUP BY ALL",
)
def prop_len(spark, sf_dir):
    out = modes.areal_aggregate(line_stats_of(spark, sf_dir), num_mode="prop_len")
    return out.select("id_cell", "date_result", F.round("value_num", 9).alias("value_num"))


def _text_query(mode: str):
    def run(spark, sf_dir):
        out = modes.areal_aggregate(poly_stats(spark, sf_dir), str_mode=mode)
        return out.select("id_cell", "date_result", "value_str")

    return run


_QUOTED = "CASE WHEN regexp_matches({0}, '^$|[,{{}}\"\\\\\\s]') THEN '\"'||replace(replace({0},'\\','\\\\'),'\"','\\\"')||'\"' ELSE {0} END"
_FULL = (
    "'{\"value_num\":\"'||" + PLAIN.format("value_num") + "||'\",\"value_str\":\"'||value_str||'\",\"cell_prop\":\"'||"
    + PLAIN.format("cell_prop") + "||'\",\"cellvalue_density\":\"'||" + PLAIN.format("cellvalue_density") + "||'\"}'"
)
_STR_FULL = "'{\"value_str\":\"'||value_str||'\",\"cell_prop\":\"'||" + PLAIN.format("cell_prop") + "||'\"}'"

TEXT = {
    "A17_value_str_mode_inter": ("value_str_mode_inter", None),
    "A16_plus_stats": ("plus_stats", PLUS),
    "A22_value_str_full": ("value_str_full", _STR_FULL),
    "A24_value_str_agg": ("value_str_agg", "value_str"),
}
for _name, (_mode, _item) in TEXT.items():
    if _mode == "value_str_mode_inter":
        _sql = f"WITH {STATS_SQL} SELECT {PAIRS}, arg_min(value_str, (-cell_prop, value_str)) AS value_str FROM stats GROUP BY ALL"
    elif _mode == "plus_stats":
        _sql = f"WITH {STATS_SQL} SELECT {PAIRS}, {_item} AS value_str FROM stats GROUP BY ALL"
    else:
        _q = _QUOTED.format("v")
        _sql = (
            f"WITH {STATS_SQL}, t AS (SELECT DISTINCT {PAIRS}, {_item} AS v FROM stats)"
            f" SELECT {PAIRS}, '{{'||string_agg({_q}, ',' ORDER BY v)||'}}' AS value_str FROM t GROUP BY {PAIRS}"
        )
    register(_name, _sql)(_text_query(_mode))


@register(
    "A21_value_full",
    f"WITH {STATS_SQL}, t AS (SELECT DISTINCT {PAIRS}, value_num, value_str, round(cell_prop,9) AS cp, round(cellvalue_density,6) AS cd FROM stats)"
    f" SELECT {PAIRS}, count(*) AS items, min(value_str) AS first_text FROM t GROUP BY {PAIRS}",
)
def value_full(spark, sf_dir):
    # the list as text holds unrounded ratios, so its items are counted back out of the text
    out = modes.areal_aggregate(poly_stats(spark, sf_dir), str_mode="value_full")
    items = F.regexp_extract_all("value_str", F.lit(r'value_str\\":\\"([^"\\]*)'), F.lit(1))
    return out.select(
        "id_cell",
        "date_result",
        F.size(items).cast("bigint").alias("items"),
        F.array_min(items).alias("first_text"),
    )


@register(
    "A23_value_num_agg",
    f"""WITH {STATS_SQL}, v AS (SELECT {PAIRS}, CASE WHEN value_num>=90 THEN NULL ELSE value_num END AS v FROM stats),
t AS (SELECT {PAIRS}, string_agg(DISTINCT CAST(CAST(v AS BIGINT) AS VARCHAR), ',') AS any_text, max(CASE WHEN v IS NULL THEN 1 ELSE 0 END) AS nul FROM v GROUP BY {PAIRS}),
d AS (SELECT DISTINCT {PAIRS}, v FROM v WHERE v IS NOT NULL),
s AS (SELECT {PAIRS}, string_agg(CAST(CAST(v AS BIGINT) AS VARCHAR), ',' ORDER BY v) AS txt FROM d GROUP BY {PAIRS})
SELECT {PAIRS}, '{{'||coalesce(txt,'')||CASE WHEN nul=1 AND txt IS NOT NULL THEN ',NULL' WHEN nul=1 THEN 'NULL' ELSE '' END||'}}' AS value_str
FROM t LEFT JOIN s USING ({PAIRS})""",
)
def value_num_agg(spark, sf_dir):
    given = poly_stats(spark, sf_dir).withColumn(
        "value_num", F.when(F.col("value_num") < 90, F.col("value_num"))
    )
    return modes.areal_aggregate(given, str_mode="value_num_agg").select(
        "id_cell", "date_result", "value_str"
    )


@register(
    "A25_empty_mode",
    f"WITH {STATS_SQL} SELECT {PAIRS}, CAST(NULL AS DOUBLE) AS value_num, CAST(NULL AS VARCHAR) AS value_str FROM stats GROUP BY ALL",
)
def empty_mode(spark, sf_dir):
    return modes.areal_aggregate(poly_stats(spark, sf_dir), "", None)


# ------------------------------------------------------------------ points

IN_CELL = f"{fx.ctes('pts', 'cells')}, pc AS (SELECT * FROM pts JOIN cells ON x BETWEEN cx0 AND cx1 AND y BETWEEN cy0 AND cy1)"


@register("J5_points_in_cells", f"WITH {IN_CELL} SELECT point_id, id_cell FROM pc")
def points_in_cells(spark, sf_dir):
    pts = fx.points(spark, sf_dir).select("point_id", "geom")
    cells = fx.cells(spark, sf_dir).select("id_cell", "geom")
    return joins.points_in_cells(pts, cells, size=200.0).select("point_id", "id_cell")


@register(
    "I3_point_stats",
    f"WITH {IN_CELL} SELECT {PAIRS}, round(avg(value_num),6) AS value_num, "
    f"'{{'||string_agg(DISTINCT value_str, ',' ORDER BY value_str)||'}}' AS value_str FROM pc GROUP BY {PAIRS}",
)
def point_stats(spark, sf_dir):
    out = stats.point_stats(
        fx.cells(spark, sf_dir), fx.points(spark, sf_dir), "val_avg", "value_str_agg", size=200.0
    )
    return rounded(out, value_num=6).select("id_cell", "date_result", "value_num", "value_str")


MAJORITY = (
    f"{IN_CELL}, cnt AS (SELECT {PAIRS}, value_str, count(*) AS n FROM pc GROUP BY ALL),"
    f" maj AS (SELECT {PAIRS}, arg_min(value_str, (-n, value_str)) AS value_str FROM cnt GROUP BY {PAIRS})"
)


@register("I5_A5_majority_value", f"WITH {MAJORITY} SELECT {PAIRS}, value_str FROM maj")
def majority(spark, sf_dir):
    out = stats.majority_value(fx.cells(spark, sf_dir), fx.points(spark, sf_dir), size=200.0)
    return out.select("id_cell", "date_result", "value_str")


KNN = f"""{fx.ctes('pts', 'cells')}, knn AS (
  SELECT id_cell, date_result, point_id, value_num, sqrt(pow(x-(cx0+100),2)+pow(y-(cy0+100),2)) AS d,
    row_number() OVER (PARTITION BY id_cell, date_result ORDER BY pow(x-(cx0+100),2)+pow(y-(cy0+100),2), point_id) AS rk
  FROM cells, pts QUALIFY rk<=8)"""


@register(
    "J6_knn_join",
    f"WITH {KNN} SELECT id_cell, date_result, point_id, round(d,6) AS distance, CAST(rk AS INTEGER) AS rank FROM knn",
)
def knn(spark, sf_dir):
    out = joins.knn_join(
        fx.cells(spark, sf_dir).select("id_cell", "geom"),
        fx.points(spark, sf_dir).select("date_result", "point_id", "value_num", "geom"),
        k=8,
        tile=400.0,
    )
    return out.select("id_cell", "date_result", "point_id", F.round("distance", 6).alias("distance"), "rank")


IDW = (
    f"{KNN}, idw AS (SELECT {PAIRS}, coalesce(avg(CASE WHEN d=0 THEN value_num END),"
    f" sum(CASE WHEN d>0 THEN value_num/d END)/sum(CASE WHEN d>0 THEN 1/d END)) AS value_num FROM knn GROUP BY {PAIRS})"
)


@register("I4_A6_idw", f"WITH {IDW} SELECT {PAIRS}, round(value_num,6) AS value_num FROM idw")
def idw(spark, sf_dir):
    out = stats.idw(fx.cells(spark, sf_dir), fx.points(spark, sf_dir), 8, 400.0)
    return rounded(out, value_num=6)


@register(
    "I6_J9_combine_modes",
    f"WITH {IDW}, {MAJORITY[len(fx.ctes('pts', 'cells')) + 2:]} SELECT {PAIRS}, round(value_num,6) AS value_num, value_str FROM idw FULL JOIN maj USING ({PAIRS})",
)
def combine(spark, sf_dir):
    cells, pts = fx.cells(spark, sf_dir), fx.points(spark, sf_dir)
    both = stats.combine_modes(
        stats.idw(cells, pts, 8, 400.0), stats.majority_value(cells, pts, size=200.0)
    )
    return rounded(both, value_num=6)


# ------------------------------------------------------------------ features of any size


def region(spark, sf_dir, parts: bool = True):
    """One mask over the whole domain with a hole of half its width and height, off every tile border."""
    from glebe.functions import wkt

    top = 40 * fx.domain_rows(spark, sf_dir)
    w, e, s, n = 1013, 2987, top // 4 + 7, 3 * (top // 4) + 3
    text = (
        f"POLYGON((5 5,{fx.WIDTH - 35} 5,{fx.WIDTH - 35} {top - 15},5 {top - 15},5 5),({w} {s},{w} {n},{e} {n},{e} {s},{w} {s}))"
    )
    row = spark.createDataFrame([(1, text)], "mask int, text string")
    return row.select("mask", wkt.parse("text", 2154).alias("geom"))


REGION = f"""box AS (SELECT 40*(-(-count(*)//100)) AS top FROM orders),
mask AS (SELECT top, 1013 AS hw, 2987 AS he, top//4+7 AS hs, 3*(top//4)+3 AS hn FROM box),
cut AS (SELECT pa.*, greatest(0, least(x1,{fx.WIDTH - 35})-greatest(x0,5))*greatest(0, least(y1,top-15)-greatest(y0,5))
  - greatest(0, least(x1,he)-greatest(x0,hw))*greatest(0, least(y1,hn)-greatest(y0,hs)) AS a FROM pa, mask)"""


@register(
    "J1_region_mask",
    f"WITH {fx.ctes('pa')}, {REGION} SELECT fid, CAST(a AS DOUBLE) AS area FROM cut WHERE a>0",
)
def region_mask(spark, sf_dir):
    from glebe.operators import cover

    found = cover.shared_areas(region(spark, sf_dir), fx.parcels_a(spark, sf_dir), "mask", "fid", TILE)
    return found.select("fid", F.round("area", 3).alias("area"))


@register(
    "J1_cover_parcels_on_cells",
    f"""WITH {fx.ctes('pa', 'cells')} SELECT fid, id_cell, CAST((least(x1,cx1)-greatest(x0,cx0))*(least(y1,cy1)-greatest(y0,cy0)) AS DOUBLE) AS area
FROM pa JOIN cells ON x0<cx1 AND x1>cx0 AND y0<cy1 AND y1>cy0""",
)
def cover_cells(spark, sf_dir):
    from glebe.operators import cover

    # a base tile that does not fit the cells, so that both layers are cut
    found = cover.shared_areas(fx.parcels_a(spark, sf_dir), fx.cells(spark, sf_dir), "fid", "id_cell", 64.0)
    return found.select("fid", "id_cell", F.round("area", 3).alias("area"))
