"""Delimited sources, inference, casts, geometry of loaded tables, sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import register
from glebe import fixtures as fx
from glebe.functions import measure as m
from glebe.functions import project
from glebe.session import scratch_path
from glebe.sources import delimited, sinks, typing, vector

C = delimited.LoadColumn


def text_columns(spark, sf_dir):
    """Orders as text: every kind of column the loader has to recognise."""
    k = F.col("o_orderkey")
    return fx.table(spark, sf_dir, "orders").select(
        k.cast("string").alias("whole"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("day"),
        F.replace(F.format_string("%.2f", "o_totalprice"), F.lit("."), F.lit(",")).alias("price"),
        F.lpad((k % 1000).cast("string"), 4, "0").alias("code"),
        F.when(k % 3 == 0, "y").when(k % 3 == 1, "n").otherwise("").alias("flag"),
        F.when(k % 5 == 0, "nc").when(k % 5 == 1, "").when(k % 5 == 2, "na").otherwise(k.cast("string")).alias("gaps"),
        F.col("o_orderpriority").alias("label"),
    )


TEXT_SQL = """txt AS (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS whole, strftime(o_orderdate, '%d/%m/%Y') AS day, o_totalprice,
  replace(printf('%.2f', o_totalprice), '.', ',') AS price, lpad(CAST(o_orderkey%1000 AS VARCHAR), 4, '0') AS code,
  CASE o_orderkey%3 WHEN 0 THEN 'y' WHEN 1 THEN 'n' ELSE '' END AS flag,
  CASE o_orderkey%5 WHEN 0 THEN 'nc' WHEN 1 THEN '' WHEN 2 THEN 'na' ELSE CAST(o_orderkey AS VARCHAR) END AS gaps, o_orderpriority AS label FROM orders)"""


@register(
    "S1_S2_S3_read_delimited",
    f"WITH {TEXT_SQL} SELECT whole AS id, label AS priority, nullif(flag,'') AS flag FROM txt WHERE label='2-HIGH'",
)
def read_delimited(spark, sf_dir):
    path = scratch_path(spark, "orders-csv")
    text_columns(spark, sf_dir).write.csv(path, sep=";", header=True, quote='"', emptyValue="")
    columns = [C("whole", "id"), C("label", "priority", condition="2-HIGH"), C("flag", "flag")]
    raw = delimited.read_delimited(spark, path)
    return delimited.select_columns(delimited.load_filter(raw, columns), columns)


COLUMNS = ["whole", "day", "price", "code", "flag", "gaps", "label"]
INFER = " UNION ALL ".join(
    f"""SELECT '{c}' AS col, CASE WHEN count(*) FILTER (WHERE {c}<>'')=0 THEN 'text'
  WHEN bool_and(lower({c}) IN ('oui','yes','true','o','y','1','t','non','no','false','n','0','f')) FILTER (WHERE {c}<>'') THEN 'boolean'
  WHEN bool_and(try_strptime({c},'%d/%m/%Y') IS NOT NULL) FILTER (WHERE {c}<>'') THEN 'date'
  WHEN bool_and(try_cast({c} AS BIGINT) IS NOT NULL AND NOT regexp_matches({c},'^0[0-9]')) FILTER (WHERE {c}<>'') THEN 'bigint'
  WHEN bool_and(try_cast(replace({c},',','.') AS DOUBLE) IS NOT NULL AND NOT regexp_matches({c},'^0[0-9]')) FILTER (WHERE {c}<>'') THEN 'numeric'
  ELSE 'text' END AS kind FROM txt"""
    for c in COLUMNS
)


@register("S4_infer_types", f"WITH {TEXT_SQL} {INFER}")
def infer(spark, sf_dir):
    found = typing.infer_types(text_columns(spark, sf_dir), COLUMNS)
    return spark.createDataFrame(sorted(found.items()), "col string, kind string")


@register(
    "S5_best_date_format",
    f"WITH {TEXT_SQL} SELECT 'd/M/yyyy' AS fmt, count(*) AS n FROM txt WHERE try_strptime(day,'%d/%m/%Y') IS NOT NULL",
)
def date_format(spark, sf_dir):
    text = text_columns(spark, sf_dir)
    fmt = typing.best_date_format(text, "day")
    day = F.try_to_timestamp("day", F.lit(fmt))
    return text.filter(day.isNotNull()).agg(F.lit(fmt).alias("fmt"), F.count("*").alias("n"))


@register(
    "S6_cast_typed",
    f"""WITH {TEXT_SQL} SELECT k AS whole, CAST(strptime(day,'%d/%m/%Y') AS DATE) AS day, CAST(replace(price,',','.') AS DOUBLE) AS price, code,
  CASE flag WHEN 'y' THEN true WHEN 'n' THEN false END AS flag, try_cast(gaps AS BIGINT) AS gaps FROM txt""",
)
def cast(spark, sf_dir):
    df = text_columns(spark, sf_dir)
    kinds = {"whole": "bigint", "day": "date", "price": "numeric", "code": "text", "flag": "boolean", "gaps": "bigint"}
    for c, kind in kinds.items():
        df = typing.cast_typed(df, c, kind)
    return df.drop("label").withColumn("price", F.col("price").cast("double"))


@register(
    "S7_timestamp_day",
    f"WITH {TEXT_SQL} SELECT k, CAST(CAST(strptime(day,'%d/%m/%Y') AS DATE) AS TIMESTAMP) AS at FROM txt",
)
def timestamps(spark, sf_dir):
    text = text_columns(spark, sf_dir)
    return text.select(
        F.col("whole").cast("bigint").alias("k"), typing.to_timestamp_day(F.col("day"), "d/M/yyyy").alias("at")
    )


WKT_RECT = "concat('POLYGON ((', x0, ' ', y0, ', ', x1, ' ', y0, ', ', x1, ' ', y1, ', ', x0, ' ', y1, ', ', x0, ' ', y0, '))')"


@register(
    "S8_G1_read_vector",
    f"WITH {fx.ctes('pa')} SELECT fid, CAST(w*h-CASE WHEN fid%2=0 THEN 100 ELSE 0 END AS DOUBLE) AS area, 2154 AS srid FROM pa WHERE fid%10<>0",
)
def read_vector(spark, sf_dir):
    """Parcels as coordinate text; even ones have a 10 m hole, every tenth has no shape."""
    from glebe.functions import geometry as g

    c = F.col("geom")
    xy = [F.col(f"geom.{n}").cast("bigint").cast("string") for n in ("xmin", "ymin", "xmax", "ymax")]
    x0, y0, x1, y1 = xy

    def ring(a, b, d, e):
        corners = [(a, b), (d, b), (d, e), (a, e), (a, b)]
        return F.concat(F.lit("("), F.concat_ws(", ", *[F.concat_ws(" ", p, q) for p, q in corners]), F.lit(")"))

    inner = [(v + d).cast("bigint").cast("string") for v, d in ((c.xmin, 5), (c.ymin, 5), (c.xmin, 15), (c.ymin, 15))]
    hole = F.when(F.col("fid") % 2 == 0, F.concat(F.lit(", "), ring(*inner))).otherwise("")
    text = F.concat(F.lit("POLYGON ("), ring(x0, y0, x1, y1), hole, F.lit(")"))
    df = fx.parcels_a(spark, sf_dir).select("fid", F.when(F.col("fid") % 10 != 0, text).alias("wkt"))
    out = vector.read_vector(df, "wkt", 2154, 2154)
    assert g.GEOMETRY == out.schema["geom"].dataType
    return out.select("fid", F.round(m.area("geom"), 6).alias("area"), F.col("geom.srid").alias("srid"))


@register(
    "S9_srid_from_prj",
    """SELECT c_custkey AS id, CASE WHEN c_custkey%3=0 THEN 4326 WHEN c_custkey%3=1 THEN 2154 END AS srid FROM customer""",
)
def srid(spark, sf_dir):
    k = F.col("c_custkey") % 3
    text = (
        F.when(k == 0, 'geogcs["gcs_wgs_1984",DATUM["D"]]')
        .when(k == 1, 'PROJCS["RGF93_Lambert_93",GEOGCS["G"]]')
        .otherwise('PROJCS["Other"]')
    )
    return fx.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), vector.srid_from_prj(text).alias("srid")
    )


@register(
    "S10_geom_by_key",
    f"WITH {fx.ctes('pa')} SELECT l_orderkey AS k, l_linenumber AS line, CAST(x0 AS DOUBLE) AS x FROM lineitem LEFT JOIN (SELECT * FROM pa WHERE fid%2=0) ON l_orderkey=fid",
)
def geom_by_key(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("line")
    )
    ref = fx.parcels_a(spark, sf_dir).filter("fid % 2 = 0").withColumn("fid", F.col("fid").cast("string"))
    out = vector.attach_geom_by_key(lines, ref, "k", "fid")
    return out.select("k", "line", F.col("geom.xmin").alias("x"))


# the projection through the isometric latitude
_E, _N = repr(project.ECC), repr(project.CONE)
_C, _NORTH = repr(project.SCALE), repr(project.FALSE_NORTHING + project.RHO_0)
_PHI = "radians(lat)"
_ISO = f"(ln(tan(pi()/4+{_PHI}/2))-{_E}/2*ln((1+{_E}*sin({_PHI}))/(1-{_E}*sin({_PHI}))))"
_R = f"{_C}*exp(-{_N}*{_ISO})"
_TH = f"{_N}*radians(lon-3)"


@register(
    "S11_G5_geom_from_xy",
    f"""WITH p AS (SELECT c_custkey AS id, -4.0+(c_custkey*7919%1300)/100.0::DOUBLE AS lon, 42.0+(c_custkey*31%900)/100.0::DOUBLE AS lat FROM customer)
SELECT id, round(700000+{_R}*sin({_TH}),3) AS x, round({_NORTH}-{_R}*cos({_TH}),3) AS y FROM p""",
)
def geom_xy(spark, sf_dir):
    k = F.col("c_custkey")
    df = fx.table(spark, sf_dir, "customer").select(
        k.alias("id"),
        ((k * 7919) % 1300 / 100 - 4).cast("string").alias("lon"),
        ((k * 31) % 900 / 100 + 42).cast("string").alias("lat"),
        F.lit("4326").alias("system"),
    )
    out = vector.attach_geom_xy(df, "lon", "lat", "system", 2154)
    return out.select("id", F.round("geom.xmin", 3).alias("x"), F.round("geom.ymin", 3).alias("y"))


@register(
    "G5_round_trip",
    "SELECT c_custkey AS id, round(-4.0+(c_custkey*7919%1300)/100.0::DOUBLE,7) AS lon, round(42.0+(c_custkey*31%900)/100.0::DOUBLE,7) AS lat FROM customer",
)
def round_trip(spark, sf_dir):
    from glebe.operators import layers

    k = F.col("c_custkey")
    df = fx.table(spark, sf_dir, "customer").select(
        k.alias("id"), ((k * 7919) % 1300 / 100 - 4).alias("lon"), ((k * 31) % 900 / 100 + 42).alias("lat")
    )
    layer = layers.reproject(layers.layer_from_xy(df, "lon", "lat", 4326), 2154)
    back = layers.reproject(layer, 4326)
    return back.select("id", F.round("geom.xmin", 7).alias("lon"), F.round("geom.ymin", 7).alias("lat"))


@register(
    "S12_geom_score",
    f"WITH {fx.ctes('pa')} SELECT round(avg(CASE WHEN fid%2=0 THEN 1.0 ELSE 0.0 END),9) AS score_geom FROM lineitem LEFT JOIN pa ON l_orderkey=fid",
)
def score(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"))
    ref = fx.parcels_a(spark, sf_dir).filter("fid % 2 = 0")
    out = vector.geom_score(vector.attach_geom_by_key(lines, ref, "k", "fid"))
    return out.select(F.round("score_geom", 9).alias("score_geom"))


@register(
    "S13_S14_tracks",
    f"""WITH {fx.ctes('pa')} SELECT 'sas' AS table_schema, 'parcels' AS table_name, 'fid' AS origin_column, 'id' AS column_name,
  (SELECT round(avg(CASE WHEN fid%4=0 THEN 0.0 ELSE 1.0 END),9) FROM pa) AS score_geom
UNION ALL SELECT 'sas','parcels','w','width', (SELECT round(avg(CASE WHEN fid%4=0 THEN 0.0 ELSE 1.0 END),9) FROM pa)""",
)
def tracks(spark, sf_dir):
    layer = fx.parcels_a(spark, sf_dir).withColumn("geom", F.when(F.col("fid") % 4 != 0, F.col("geom")))
    value = vector.geom_score(layer).first()["score_geom"]
    table = sinks.track_table(spark, "sas", "parcels", False, "parcels.csv", 2154, "test", "tester", value)
    job = spark.createDataFrame(
        [("fid", "id", ""), ("w", "width", "")], "origin_column string, column_name string, description string"
    )
    columns = sinks.track_columns(job, "sas", "parcels", "tester")
    both = columns.join(table.select("table_schema", "table_name", "score_geom"), ["table_schema", "table_name"])
    return both.select(
        "table_schema", "table_name", "origin_column", "column_name", F.round("score_geom", 9).alias("score_geom")
    )


@register(
    "S15_save_table",
    "SELECT o_orderkey AS k, o_orderpriority AS label, CAST(o_custkey AS DOUBLE) AS v FROM orders",
)
def save_table(spark, sf_dir):
    path = scratch_path(spark, "table")
    src = fx.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("label"), F.col("o_custkey").alias("v")
    )
    sinks.save_table(src.filter("k % 2 = 0").withColumn("v", F.col("v").cast("double")), path, primary_key=["k"])
    odd = src.filter("k % 2 = 1").select(F.col("v").cast("string").alias("v"), F.col("k").cast("string").alias("k"), "label")
    sinks.save_table(odd, path, append=True, primary_key=["k"])
    return spark.read.parquet(path)


TABLES_JOB = [
    # schema, table, file, append, system of the result, system of the file, go
    ("sas", "sites", "customers", "false", "2154", "system", "1"),
    ("sas", "orders", "orders_even", "false", "2154", "", "1"),
    ("sas", "orders", "orders_odd", "true", "2154", "", "1"),
    ("sas", "later", "orders_odd", "false", "2154", "", "0"),
    ("sas", "wrong", "orders_odd", "false", "2154", "", "1"),
]
COLUMNS_JOB = [
    # table, origin column, column, condition, primary key, role of a coordinate, key of the reference table
    ("sites", "key", "cust", "", "true", "", ""),
    ("sites", "lon", "lon", "", "", "x", ""),
    ("sites", "lat", "lat", "", "", "y", ""),
    ("sites", "system", "system", "", "", "", ""),
    ("orders", "key", "id", "", "true", "", ""),
    ("orders", "day", "day", "", "", "", ""),
    ("orders", "total", "total", "", "", "", ""),
    ("orders", "customer", "cust", "", "", "", "cust"),
    ("orders", "status", "status", "O", "", "", ""),
    ("wrong", "no such column", "x", "", "", "", ""),
]


@register(
    "S1_S15_load_job",
    f"""WITH p AS (SELECT c_custkey AS cust, -4.0+(c_custkey*7919%1300)/100.0::DOUBLE AS lon, 42.0+(c_custkey*31%900)/100.0::DOUBLE AS lat FROM customer)
SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS day, round(CAST(o_totalprice AS DOUBLE),2) AS total, o_custkey AS cust,
  round(700000+{_R}*sin({_TH}),3) AS x, round({_NORTH}-{_R}*cos({_TH}),3) AS y,
  (SELECT avg(CASE WHEN cust IS NULL THEN 0.0 ELSE 1.0 END) FROM orders LEFT JOIN p ON cust=o_custkey WHERE o_orderstatus='O') AS score_geom
FROM orders LEFT JOIN p ON cust=o_custkey WHERE o_orderstatus='O'""",
)
def load_job(spark, sf_dir):
    from glebe.plans import loading

    folder = scratch_path(spark, "loaded")
    k = F.col("c_custkey")
    fx.table(spark, sf_dir, "customer").select(
        k.alias("key"), ((k * 7919) % 1300 / 100 - 4).cast("string").alias("lon"), ((k * 31) % 900 / 100 + 42).cast("string").alias("lat"),
        F.lit("4326").alias("system"),
    ).write.csv(f"{folder}/in/customers", sep=";", header=True)
    orders = fx.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"), F.date_format("o_orderdate", "dd/MM/yyyy").alias("day"),
        F.replace(F.round(F.col("o_totalprice").cast("double"), 2).cast("decimal(20,2)").cast("string"), F.lit("."), F.lit(",")).alias("total"),
        F.col("o_custkey").alias("customer"), F.col("o_orderstatus").alias("status"),
    )
    for name, rest in (("even", 0), ("odd", 1)):
        orders.filter(F.col("key") % 2 == rest).write.csv(f"{folder}/in/orders_{name}", sep=";", header=True)
    tables = spark.createDataFrame(
        [(s, t, f"{folder}/in/{f}", a, d, i, "a load", go) for s, t, f, a, d, i, go in TABLES_JOB],
        "table_schema string, table_name string, origin_file string, append string, dest_srid string, proj_init_ifproj string, description string, go string",
    )
    columns = spark.createDataFrame(
        [("sas", *c, "sas" if c[-1] else "", "sites" if c[-1] else "", "a column") for c in COLUMNS_JOB],
        "table_schema string, table_name string, origin_column string, column_name string, condition string, primary_key string,"
        " coordinates_ifproj string, geom_join_on string, ref_geom_table_schema string, ref_geom_table_name string, description string",
    )
    report = {r["table"]: r["status"] for r in loading.load_tables(tables, columns, folder, "tester").collect()}
    if report != {"sas.sites": "done", "sas.orders": "done", "sas.later": "skipped", "sas.wrong": "failed"}:
        raise RuntimeError(f"unexpected report: {report}")
    tracks = spark.read.parquet(f"{folder}/sas/table_tracks").filter("table_name = 'orders' AND append").select("score_geom")
    loaded = spark.read.parquet(f"{folder}/sas/orders").select(
        "id", "day", F.round(F.col("total").cast("double"), 2).alias("total"), "cust", F.round("geom.xmin", 3).alias("x"), F.round("geom.ymin", 3).alias("y")
    )
    return loaded.crossJoin(F.broadcast(tracks))
