"""Grids, datasets, indicator builds, stored results and pivots."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks import register
from checks.indicators import IN_CELL, PAIRS, STATS_SQL, rounded
from glebe import fixtures as fx
from glebe.functions import measure as m
from glebe.operators import grids, results
from glebe.plans import indicator as plan
from glebe.session import scratch_path
from glebe.sources import sinks

CELLS = fx.ctes("cells")


def _loaded(spark, sf_dir):
    """Cells of which every third is missing."""
    return fx.cells(spark, sf_dir).filter(F.col("id_cell") % 3 != 0)


@register(
    "R1_grid_replace",
    f"WITH {CELLS} SELECT count(*) AS n, count(DISTINCT cell_code) AS codes, min(200*1) AS side, CAST(min(id) AS BIGINT) AS low, CAST(max(id) AS BIGINT) AS high"
    f" FROM (SELECT cell_code, row_number() OVER (ORDER BY cell_code) AS id FROM cells)",
)
def grid_replace(spark, sf_dir):
    out = grids.build_grid(_loaded(spark, sf_dir), fx.cells(spark, sf_dir).drop("id_cell"), 1)
    return out.agg(
        F.count("*").alias("n"),
        F.count_distinct("id_cell").alias("codes"),
        F.min(F.col("geom.xmax") - F.col("geom.xmin")).cast("int").alias("side"),
        F.min("id_cell").alias("low"),
        F.max("id_cell").alias("high"),
    )


@register(
    "R2_J7_grid_add_missing",
    f"WITH {CELLS} SELECT cell_code, id_cell%3=0 AS added, CASE WHEN id_cell%3=0 THEN true ELSE false END AS new_id FROM cells",
)
def grid_add(spark, sf_dir):
    old = _loaded(spark, sf_dir)
    source = fx.cells(spark, sf_dir).drop("id_cell").withColumn(
        "cell_code", F.when(F.col("cell_code") != "", F.col("cell_code"))
    )
    top = old.agg(F.max("id_cell")).first()[0]
    out = grids.build_grid(old, source, 1, mode="adddiff")
    keys = old.select("cell_code", F.lit(True).alias("old"))
    return out.join(keys, "cell_code", "left").select(
        "cell_code", F.col("old").isNull().alias("added"), (F.col("id_cell") > top).alias("new_id")
    )


@register("J7_missing_codes", f"WITH {CELLS} SELECT cell_code FROM cells WHERE id_cell%3=0")
def missing(spark, sf_dir):
    return grids.missing_codes(fx.cells(spark, sf_dir), _loaded(spark, sf_dir)).select("cell_code")


@register(
    "R3_J8_grid_update_geometry",
    f"WITH {CELLS} SELECT id_cell, CAST(cx0+CASE WHEN cy0>=400 THEN 7 ELSE 0 END AS DOUBLE) AS x FROM cells",
)
def grid_update(spark, sf_dir):
    from glebe.functions import geometry as g

    cells = fx.cells(spark, sf_dir)
    c = F.col("geom")
    moved = cells.filter(c.ymin >= 400).withColumn(
        "geom", g.rectangle(c.xmin + 7, c.ymin, c.xmax + 7, c.ymax)
    )
    out = grids.build_grid(cells, moved.drop("id_cell"), 1, mode="updategeom")
    return out.select("id_cell", F.col("geom.xmin").alias("x"))


@register(
    "R4_G17_cross_grid",
    f"""WITH {STATS_SQL} SELECT cell_code, CAST(25*count(*) AS DOUBLE) AS area FROM (
  SELECT DISTINCT cell_code, sx, sy FROM (SELECT id_cell, cell_code FROM cells) JOIN pieces USING (id_cell),
    unnest(range(px0//5, px1//5)) AS t(sx), unnest(range(py0//5, py1//5)) AS u(sy)
  WHERE value_str IN ('1-URGENT','2-HIGH')) GROUP BY cell_code""",
)
def cross_grid(spark, sf_dir):
    out = grids.cross_grid(
        fx.cells(spark, sf_dir), fx.poly_data(spark, sf_dir), "value_str IN ('1-URGENT','2-HIGH')"
    )
    return out.select("cell_code", F.round(m.area("geom"), 6).alias("area"))


@register(
    "R5_upsert_reference",
    """WITH ref AS (SELECT n_name AS name FROM nation WHERE n_nationkey%2=0), fresh AS (SELECT DISTINCT n_name FROM nation WHERE n_name NOT IN (SELECT name FROM ref))
SELECT (SELECT count(*) FROM ref)+(SELECT count(*) FROM fresh) AS n, (SELECT count(*) FROM ref)+(SELECT count(*) FROM fresh) AS ids,
 (SELECT max(n_nationkey)+1 FROM nation WHERE n_nationkey%2=0)::BIGINT + (SELECT count(*) FROM fresh) AS top""",
)
def upsert(spark, sf_dir):
    nation = fx.table(spark, sf_dir, "nation")
    ref = nation.filter("n_nationkey % 2 = 0").select(
        (F.col("n_nationkey") + 1).cast("bigint").alias("id_legend"), F.col("n_name").alias("content")
    )
    rows = nation.select(F.col("n_name").alias("content"))
    out = grids.upsert_ref(ref, rows.unionByName(rows), "content", "id_legend")
    return out.agg(
        F.count("*").alias("n"),
        F.count_distinct("id_legend").alias("ids"),
        F.max("id_legend").alias("top"),
    )


@register(
    "R6_dataset_fixed_date",
    f"""WITH {fx.ctes('pa')} SELECT DATE '2020-03-01' AS date_result, CAST(7 AS BIGINT) AS id_variable, fid, o_orderpriority AS value_str,
  CAST(o_custkey AS DOUBLE) AS value_num, '{{"cust":'||o_custkey||'}}' AS info FROM pa WHERE o_custkey%2=0""",
)
def dataset_fixed(spark, sf_dir):
    spec = grids.DatasetSpec(
        7,
        "01/03/2020",
        source_column="o_custkey",
        is_numeric=True,
        use_field_str="o_orderpriority",
        json_expression="to_json(named_struct('cust', o_custkey))",
        source_condition="o_custkey % 2 = 0",
    )
    # the parcel number rides along in the geometry's place
    src = fx.parcels_a(spark, sf_dir, "o_custkey", "o_orderpriority").withColumn("geom", F.col("fid"))
    return grids.build_dataset(src, spec).withColumnRenamed("geom", "fid")


@register(
    "R7_dataset_date_column",
    f"""WITH {fx.ctes('pa')} SELECT CAST(o_orderdate AS DATE) AS date_result, count(*) AS n, min(o_orderpriority) AS first_value,
  CAST(NULL AS DOUBLE) AS num FROM pa GROUP BY ALL""",
)
def dataset_dates(spark, sf_dir):
    spec = grids.DatasetSpec(8, "o_orderdate", source_column="o_orderpriority")
    out = grids.build_dataset(fx.parcels_a(spark, sf_dir, "o_orderdate", "o_orderpriority"), spec)
    return out.groupBy("date_result").agg(
        F.count("*").alias("n"), F.min("value_str").alias("first_value"), F.max("value_num").alias("num")
    )


# ------------------------------------------------------------------ indicator builds


def _datasets(spark, sf_dir):
    """Stored observations of a polygon (1) and a point (3) variable."""
    poly = fx.poly_data(spark, sf_dir).withColumn("id_variable", F.lit(1).cast("bigint"))
    pts = fx.points(spark, sf_dir).drop("point_id").withColumn("id_variable", F.lit(3).cast("bigint"))
    return poly.unionByName(pts)


SHARE = plan.IndicatorSpec(
    11, 1, 1, "prop_surf", "value_str_mode_inter", condition_variable="value_num >= 20"
)
BUILD = f"""{STATS_SQL},
built AS (SELECT date_result, CAST(11 AS BIGINT) AS id_indicator, id_cell, arg_min(value_str, (-cell_prop, value_str)) AS value_str,
  round(sum(cell_prop),9) AS value_num FROM stats WHERE value_num>=20 GROUP BY date_result, id_cell)"""


def _built(spark, sf_dir):
    return plan.build_indicator(fx.cells(spark, sf_dir), _datasets(spark, sf_dir), SHARE)


@register("I7_I8_I9_build_indicator", f"WITH {BUILD} SELECT * FROM built")
def build(spark, sf_dir):
    return rounded(_built(spark, sf_dir), value_num=9)


@register(
    "I9_build_point_indicator",
    f"""WITH {IN_CELL}, cnt AS (SELECT {PAIRS}, value_str, count(*) AS n FROM pc GROUP BY ALL),
maj AS (SELECT {PAIRS}, arg_min(value_str, (-n, value_str)) AS value_str FROM cnt GROUP BY ALL),
num AS (SELECT {PAIRS}, round(max(value_num),6) AS value_num FROM pc GROUP BY {PAIRS})
SELECT date_result, CAST(12 AS BIGINT) AS id_indicator, id_cell, value_str, value_num FROM num FULL JOIN maj USING ({PAIRS})""",
)
def build_points(spark, sf_dir):
    spec = plan.IndicatorSpec(12, 3, 1, "val_max", "value_str_mode_ct_pt", cell_size=200.0)
    out = plan.build_indicator(fx.cells(spark, sf_dir), _datasets(spark, sf_dir), spec)
    return rounded(out, value_num=6)


@register(
    "I10_J12_resume",
    f"""WITH {STATS_SQL}, done AS (SELECT DISTINCT {PAIRS} FROM stats WHERE NOT (year(date_result)=1997 AND id_cell%5=0) AND year(date_result)<>1999)
SELECT DISTINCT id_cell, date_result FROM stats ANTI JOIN done USING ({PAIRS})""",
)
def resume(spark, sf_dir):
    cells, data = fx.cells(spark, sf_dir), fx.poly_data(spark, sf_dir)
    from glebe.operators.joins import spatial_join

    year = F.year("date_result")
    done = (
        spatial_join(data, cells.select("id_cell", "geom"))
        .select("id_cell", "date_result")
        .filter(~((year == 1997) & (F.col("id_cell") % 5 == 0)) & (year != 1999))
    )
    return results.cells_to_compute(cells, data, done)


@register(
    "I10_resume_build",
    f"WITH {BUILD}, gap AS (SELECT DISTINCT date_result FROM stats WHERE year(date_result)=1997) SELECT * FROM built WHERE date_result IN (SELECT date_result FROM gap)",
)
def resume_build(spark, sf_dir):
    cells, data = fx.cells(spark, sf_dir), _datasets(spark, sf_dir)
    spec = plan.IndicatorSpec(11, 1, 1, "ct_elt")
    everything = plan.build_indicator(cells, data, spec)
    done = everything.filter(
        (F.year("date_result") != 1997) | (F.col("id_cell") % 5 != 0)
    )
    return rounded(plan.build_indicator(cells, data, SHARE, existing=done), value_num=9)


JOB_HEAD = "name;work_variable;work_grid;num_mode;str_mode;condition_variable;exploits_grid;go"
JOBS = """share;parcels;squares;prop_surf;value_str_mode_inter;value_num >= 20;shifted;1
count;parcels;squares;ct_elt;;;;1
highest;events;squares;val_max;;;;1
resumed;parcels;squares;val_sum;;value_num < 50;;2
idle;parcels;squares;val_sum;;;;0
broken;parcels;nowhere;val_sum;;;;1
odd;parcels;squares;no_mode;;;;1
unread;parcels;squares;val_sum;;no_column = 1;;1
"""


def _shifted(spark, sf_dir):
    """Half the cells, a kilometre to the east, as another grid."""
    from glebe.functions import geometry as g

    c = F.col("geom")
    return fx.cells(spark, sf_dir).filter("id_cell % 2 = 0").select(
        (F.col("id_cell") + 1_000_000).alias("id_cell"), "cell_code", F.lit(2).alias("id_grid"),
        g.rectangle(c.xmin + 1000, c.ymin, c.xmax + 1000, c.ymax).alias("geom"),
    )


def job_run(spark, sf_dir):
    """Results, indicators, report and pivots of the job file, after an earlier run that left 1997 incomplete."""
    from glebe.plans import jobs

    cells = fx.cells(spark, sf_dir).unionByName(_shifted(spark, sf_dir))
    variables = spark.createDataFrame([(1, "parcels"), (3, "events")], "id_variable long, name string")
    names = spark.createDataFrame([(1, "squares"), (2, "shifted")], "id_grid int, name string")
    known = spark.createDataFrame([(5, "older")], "id_indicator long, name string")
    path, log, pivots, config = (scratch_path(spark, n) for n in ("results", "log", "pivots", "config"))
    where = dict(results_path=path, log_path=log, exploits_path=pivots, user="tester", cell_size=200.0)
    line = next(x for x in JOBS.splitlines() if x.startswith("resumed")).replace(";2", ";1")

    def run(lines: str, ids):
        folder = f"{config}/{lines[:5]}"
        text = [JOB_HEAD, *lines.splitlines()]
        spark.createDataFrame([(i, x) for i, x in enumerate(text)], "i int, value string").coalesce(1).sortWithinPartitions("i").select("value").write.text(folder)
        return jobs.run_job_file(spark, folder, cells, _datasets(spark, sf_dir), variables, names, ids, **where)

    known, _ = run(line, known)
    stored = spark.read.parquet(path).withColumn("value_num", F.lit(-1.0))
    gaps = stored.filter((F.year("date_result") != 1997) | (F.col("id_cell") % 5 != 0))
    plan.publish(gaps.select("date_result", "id_indicator", "id_cell", "value_str", "value_num"), path, log, "tester")
    known, report = run(JOBS, known)
    return spark.read.parquet(path), known, report, pivots


@register(
    "R8_run_jobs",
    f"""WITH {BUILD}, pts AS (SELECT * FROM (WITH {IN_CELL} SELECT {PAIRS}, max(value_num) AS value_num FROM pc GROUP BY {PAIRS})),
gap AS (SELECT DISTINCT date_result FROM stats WHERE value_num<50 AND year(date_result)=1997 AND id_cell%5=0)
SELECT 'share' AS name, CAST(date_result AS DATE) AS date_result, id_cell, value_str, value_num FROM built
UNION ALL SELECT 'count', CAST(date_result AS DATE), id_cell, NULL, CAST(count(*) AS DOUBLE) FROM stats GROUP BY ALL
UNION ALL SELECT 'highest', CAST(date_result AS DATE), id_cell, NULL, round(CAST(value_num AS DOUBLE),9) FROM pts
UNION ALL SELECT 'resumed', CAST(date_result AS DATE), id_cell, NULL,
  CASE WHEN date_result IN (SELECT date_result FROM gap) THEN CAST(sum(value_num) AS DOUBLE) ELSE -1 END FROM stats WHERE value_num<50 GROUP BY date_result, id_cell""",
)
def run_jobs(spark, sf_dir):
    found, known, _, _ = job_run(spark, sf_dir)
    return rounded(
        found.join(F.broadcast(known), "id_indicator").select(
            "name", F.col("date_result").cast("date"), F.col("id_cell").cast("bigint"), "value_str", "value_num"
        ), value_num=9,
    )


@register(
    "R8_exploits_grid",
    f"""WITH {BUILD} SELECT cell_code, CAST(cx0+1000 AS DOUBLE) AS x, CAST(date_result AS DATE) AS date_result, value_num
FROM built JOIN cells USING (id_cell) WHERE id_cell%2=0""",
)
def run_jobs_exploited(spark, sf_dir):
    _, known, _, pivots = job_run(spark, sf_dir)
    number = known.filter("name = 'share'").first()["id_indicator"]
    wide = spark.read.parquet(f"{pivots}/num_{number}_2")
    dates = [c for c in wide.columns if c.startswith("value_")]
    rows = F.array(*[F.struct(F.to_date(F.lit(c[6:]), "yyyyMMdd").alias("date_result"), F.col(c).alias("value_num")) for c in dates])
    long = wide.select("cell_code", F.col("geom.xmin").alias("x"), F.inline(rows)).filter("value_num IS NOT NULL")
    return rounded(long, value_num=9)


@register(
    "S16_S17_partition_replace",
    f"""WITH {BUILD} SELECT id_cell, date_result, CASE WHEN year(date_result)=1998 THEN -1 ELSE value_num END AS value_num FROM built""",
)
def partition_replace(spark, sf_dir):
    path, log = scratch_path(spark, "results"), scratch_path(spark, "log")
    first = rounded(_built(spark, sf_dir), value_num=9)
    plan.publish(first, path, log, "tester")
    again = spark.read.parquet(path).filter(F.year("date_result") == 1998)
    again = again.select(
        F.lit(-1.0).alias("value_num"), "value_str", "id_cell", "date_result", "id_indicator"
    )
    plan.publish(again, path, log, "tester")
    return spark.read.parquet(path).select(
        F.col("id_cell").cast("bigint"), F.col("date_result").cast("date"), "value_num"
    )


@register(
    "S17_update_log",
    f"WITH {BUILD} SELECT date_result, CAST(11 AS BIGINT) AS id_updated, 'indicator' AS kind, 'tester' AS feeduser FROM built GROUP BY date_result",
)
def update_log(spark, sf_dir):
    return sinks.log_update(_built(spark, sf_dir), "indicator", "id_indicator", "tester").drop("date_real")


YEARS = [dt.date(y, 1, 1) for y in range(1995, 2002)]


def _wide(value: str, agg: str = "min") -> str:
    return ", ".join(
        f"{agg}(CASE WHEN date_result=DATE '{d}' THEN {value} END) AS value_{d:%Y%m%d}" for d in YEARS
    )


@register(
    "J10_results_with_cells",
    f"WITH {BUILD} SELECT id_cell, cell_code, date_result, value_num, CAST(cx0 AS DOUBLE) AS x FROM built JOIN cells USING (id_cell)",
)
def with_cells(spark, sf_dir):
    out = results.results_with_cells(rounded(_built(spark, sf_dir), value_num=9), fx.cells(spark, sf_dir))
    return out.select("id_cell", "cell_code", "date_result", "value_num", F.col("geom.xmin").alias("x"))


@register(
    "I11_I15_pivot_numeric",
    f"WITH {BUILD} SELECT id_cell, cell_code, {_wide('value_num')} FROM built JOIN cells USING (id_cell) GROUP BY id_cell, cell_code",
)
def pivot_num(spark, sf_dir):
    found = rounded(_built(spark, sf_dir), value_num=9)
    return results.pivot_results(found, fx.cells(spark, sf_dir), "num", YEARS).drop("geom")


@register(
    "I12_I13_pivot_text_stored",
    f"WITH {BUILD} SELECT id_cell, cell_code, {_wide('value_str')} FROM built JOIN cells USING (id_cell) GROUP BY id_cell, cell_code",
)
def pivot_text(spark, sf_dir):
    path = scratch_path(spark, "pivot")
    wide = results.pivot_results(_built(spark, sf_dir), fx.cells(spark, sf_dir), "str", YEARS)
    results.save_pivot(wide, path)
    return spark.read.parquet(path).drop("geom")


@register(
    "I14_J11_pivot_on_grid",
    f"WITH {BUILD} SELECT id_cell, cell_code, CAST(cx0+1000 AS DOUBLE) AS x, {_wide('value_num')} FROM built JOIN cells USING (id_cell) WHERE id_cell%2=0 GROUP BY ALL",
)
def pivot_other(spark, sf_dir):
    from glebe.functions import geometry as g

    cells, c = fx.cells(spark, sf_dir), F.col("geom")
    other = cells.filter("id_cell % 2 = 0").select(
        "cell_code",
        F.lit(2).alias("id_grid"),
        g.rectangle(c.xmin + 1000, c.ymin, c.xmax + 1000, c.ymax).alias("geom"),
    )
    wide = results.pivot_results(rounded(_built(spark, sf_dir), value_num=9), cells, "num", YEARS)
    return results.pivot_on_grid(wide, other, 2).withColumn("geom", F.col("geom.xmin")).withColumnRenamed("geom", "x")




# ------------------------------------------------------------------ grids and pivots from table columns, row by row


def _grid_source(spark, sf_dir, step: int = 0):
    """Parcels as the cells of a source grid; every second one moved by ``step`` metres."""
    from glebe.functions import geometry as g

    c, move = F.col("geom"), F.when(F.col("fid") % 2 == 0, F.lit(float(step))).otherwise(F.lit(0.0))
    return fx.parcels_a(spark, sf_dir).select(
        F.concat(F.lit("P"), F.col("fid").cast("string")).alias("cell_code"), "fid",
        g.rectangle(c.xmin + move, c.ymin + move, c.xmax + move, c.ymax + move).alias("geom"),
    )


def _grid_stored(spark, sf_dir):
    """The grid as loaded before: two thirds of the parcels under ids of their own, and a cell of another grid."""
    from glebe.functions import geometry as g

    mine = _grid_source(spark, sf_dir).filter("fid % 3 <> 0").select((F.col("fid") + 10).alias("id_cell"), "cell_code", F.lit(1).alias("id_grid"), "geom")
    other = fx.table(spark, sf_dir, "nation").select(
        (-F.col("n_nationkey") - 1).cast("bigint").alias("id_cell"), F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("cell_code"),
        F.lit(2).alias("id_grid"), g.rectangle(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.col("n_nationkey") + 1.0).alias("geom"),
    )
    return mine.unionByName(other)


BOX = ["xmin", "ymin", "xmax", "ymax"]
PARCEL_BOX = "CAST(x0 AS DOUBLE) AS xmin, CAST(y0 AS DOUBLE) AS ymin, CAST(x1 AS DOUBLE) AS xmax, CAST(y1 AS DOUBLE) AS ymax"
NATION_CELLS = "SELECT 'N'||n_nationkey AS cell_code, 2 AS id_grid, 0.0::DOUBLE, 0.0::DOUBLE, 1.0::DOUBLE, CAST(n_nationkey+1 AS DOUBLE)"


def _boxes(df, *columns):
    return df.select("cell_code", "id_grid", *[F.col(f"geom.{n}").alias(n) for n in BOX], *columns)


@register(
    "R1_grid_replace_rows",
    f"""WITH {fx.ctes('pa')}, top AS (SELECT -1 AS kept, count(*) AS n FROM pa) SELECT 'P'||fid AS cell_code, 1 AS id_grid, {PARCEL_BOX},
  true AS new_id FROM pa UNION ALL {NATION_CELLS}, false FROM nation""",
)
def grid_replace_rows(spark, sf_dir):
    out = grids.build_grid(_grid_stored(spark, sf_dir), _grid_source(spark, sf_dir), 1)
    n = fx.table(spark, sf_dir, "orders").count()
    # the new ids follow the largest one that stays, each once
    ids = out.filter("id_grid = 1").select("id_cell").distinct().withColumn("fresh", F.col("id_cell").between(0, n - 1))
    return _boxes(out.join(ids, "id_cell", "left"), F.coalesce("fresh", F.lit(False)).alias("new_id"))


@register(
    "R2_J7_grid_add_rows",
    f"""WITH {fx.ctes('pa')} SELECT 'P'||fid AS cell_code, 1 AS id_grid, {PARCEL_BOX},
  CASE WHEN fid%3<>0 THEN fid+10 END AS old_id FROM pa UNION ALL {NATION_CELLS}, -n_nationkey-1 FROM nation""",
)
def grid_add_rows(spark, sf_dir):
    stored = _grid_stored(spark, sf_dir)
    out = grids.build_grid(stored, _grid_source(spark, sf_dir, 5).filter("fid % 3 = 0 OR fid % 2 = 0"), 1, mode="adddiff")
    odd = _grid_source(spark, sf_dir).filter("fid % 3 = 0 AND fid % 2 = 0")
    # stored geometry stays; added even ones come moved, and are moved back for the comparison
    back = odd.select("cell_code", F.col("geom").alias("unmoved"))
    top = stored.agg(F.max("id_cell")).first()[0]
    fixed = out.join(back, "cell_code", "left").withColumn("geom", F.coalesce("unmoved", "geom"))
    return _boxes(fixed, F.when(F.col("id_cell") <= top, F.col("id_cell")).alias("old_id"))


@register("J7_missing_rows", f"WITH {fx.ctes('pa')} SELECT 'P'||fid AS cell_code, CAST(x0 AS DOUBLE) AS xmin, CAST(y1 AS DOUBLE) AS ymax FROM pa WHERE fid%3=0")
def missing_rows(spark, sf_dir):
    out = grids.missing_codes(_grid_source(spark, sf_dir), _grid_stored(spark, sf_dir))
    return out.select("cell_code", "geom.xmin", "geom.ymax")


@register(
    "R3_J8_grid_update_rows",
    f"""WITH {fx.ctes('pa')}, m AS (SELECT *, CASE WHEN fid%2=0 THEN 15 ELSE 0 END AS s FROM pa WHERE fid%3<>0)
SELECT 'P'||fid AS cell_code, 1 AS id_grid, CAST(x0+s AS DOUBLE) AS xmin, CAST(y0+s AS DOUBLE) AS ymin, CAST(x1+s AS DOUBLE) AS xmax, CAST(y1+s AS DOUBLE) AS ymax,
  fid+10 AS id_cell FROM m UNION ALL {NATION_CELLS}, -n_nationkey-1 FROM nation""",
)
def grid_update_rows(spark, sf_dir):
    out = grids.build_grid(_grid_stored(spark, sf_dir), _grid_source(spark, sf_dir, 15), 1, mode="updategeom")
    return _boxes(out, "id_cell")


def _long(wide, *keys):
    """A pivot by date as rows again."""
    dates = [c for c in wide.columns if c.startswith("value_")]
    rows = F.array(*[F.struct(F.to_date(F.lit(c[6:]), "yyyyMMdd").alias("date_result"), F.col(c).alias("value")) for c in dates])
    return wide.select(*keys, F.inline(rows)).filter("value IS NOT NULL")


@register(
    "I11_I15_pivot_every_date",
    f"WITH {BUILD} SELECT id_cell, cell_code, CAST(date_result AS DATE) AS date_result, value_num AS value FROM built JOIN cells USING (id_cell)",
)
def pivot_num_all(spark, sf_dir):
    found = rounded(_built(spark, sf_dir), value_num=9)
    return _long(results.pivot_results(found, fx.cells(spark, sf_dir), "num"), "id_cell", "cell_code")


@register(
    "I12_I13_pivot_text_every_date",
    f"WITH {BUILD} SELECT id_cell, cell_code, CAST(date_result AS DATE) AS date_result, value_str AS value FROM built JOIN cells USING (id_cell) WHERE value_str IS NOT NULL",
)
def pivot_text_all(spark, sf_dir):
    path = scratch_path(spark, "pivot")
    results.save_pivot(results.pivot_results(_built(spark, sf_dir), fx.cells(spark, sf_dir), "str"), path)
    return _long(spark.read.parquet(path), "id_cell", "cell_code")


@register(
    "I14_J11_pivot_on_grid_every_date",
    f"WITH {BUILD} SELECT cell_code, CAST(cx0+1000 AS DOUBLE) AS x, CAST(date_result AS DATE) AS date_result, value_num AS value FROM built JOIN cells USING (id_cell) WHERE id_cell%2=0",
)
def pivot_other_all(spark, sf_dir):
    found = rounded(_built(spark, sf_dir), value_num=9)
    wide = results.pivot_on_grid(results.pivot_results(found, fx.cells(spark, sf_dir), "num"), _shifted(spark, sf_dir), 2)
    return _long(wide.withColumn("x", F.col("geom.xmin")), "cell_code", "x")
