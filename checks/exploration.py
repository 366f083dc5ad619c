"""Slices, thresholds, differences and crossings of published indicators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks import register
from glebe import fixtures as fx
from glebe.operators import explore

RES = fx.ctes("res")
NUM, NUM2, CAT, CAT2 = "2-HIGH", "3-MEDIUM", "1-URGENT", "5-LOW"
DAY = dt.date(1998, 1, 1)
AT = "date_result=DATE '1998-01-01'"


def text_of(name: str):
    return F.array_join(F.transform(name, lambda d: d.cast("string")), ",")


@register(
    "E1_indicator_kinds",
    f"WITH {RES} SELECT name, CASE WHEN count(value_num)>0 THEN 'numeric' ELSE 'categorical' END AS kind FROM res GROUP BY name",
)
def kinds(spark, sf_dir):
    return explore.indicator_kinds(fx.results(spark, sf_dir))


@register(
    "E2_indicator_dates",
    f"WITH {RES} SELECT name, string_agg(DISTINCT CAST(date_result AS VARCHAR), ',' ORDER BY CAST(date_result AS VARCHAR)) AS dates FROM res GROUP BY name",
)
def dates(spark, sf_dir):
    return explore.indicator_dates(fx.results(spark, sf_dir)).withColumn("dates", text_of("dates"))


@register(
    "E3_category_domain",
    f"WITH {RES} SELECT name, string_agg(DISTINCT max_cell_prop_value, ',' ORDER BY max_cell_prop_value) AS categories FROM res WHERE max_cell_prop_value IS NOT NULL GROUP BY name",
)
def domain(spark, sf_dir):
    return explore.category_domain(fx.results(spark, sf_dir)).withColumn("categories", text_of("categories"))


@register("E4_indicator_at", f"WITH {RES} SELECT id_cell, value_num FROM res WHERE name='{NUM}' AND {AT} AND value_num IS NOT NULL")
def at(spark, sf_dir):
    return explore.indicator_at(fx.results(spark, sf_dir), NUM, DAY, "numeric").select("id_cell", "value_num")


@register(
    "E5_threshold",
    f"WITH {RES} SELECT id_cell, CASE WHEN value_num>150 THEN 'High' ELSE 'Low' END AS threshold_value FROM res WHERE name='{NUM}' AND {AT}",
)
def threshold(spark, sf_dir):
    return explore.threshold(fx.results(spark, sf_dir), NUM, DAY, 150).select("id_cell", "threshold_value")


@register(
    "E6_threshold_range",
    f"WITH {RES} SELECT min(value_num) AS low, max(value_num) AS high, (max(value_num)-min(value_num))/2 AS start, (max(value_num)-min(value_num))/10 AS step FROM res WHERE name='{NUM}' AND {AT}",
)
def threshold_range(spark, sf_dir):
    return explore.threshold_range(fx.results(spark, sf_dir), NUM, DAY)


def _bounds(name: str, value: str) -> str:
    return (
        f"one AS (SELECT * FROM res WHERE name='{name}' AND {value} IS NOT NULL), b AS (SELECT min(date_result) AS d0, max(date_result) AS d1 FROM one),"
        f" w AS (SELECT id_cell, max(CASE WHEN date_result=d0 THEN {value} END) AS a, max(CASE WHEN date_result=d1 THEN {value} END) AS z FROM one, b GROUP BY id_cell)"
    )


@register("E7_delta_numeric", f"WITH {RES}, {_bounds(NUM, 'value_num')} SELECT id_cell, z-a AS delta FROM w")
def delta_numeric(spark, sf_dir):
    return explore.delta_numeric(fx.results(spark, sf_dir), NUM)


@register(
    "E8_delta_category",
    f"WITH {RES}, {_bounds(CAT, 'max_cell_prop_value')} SELECT id_cell, CASE WHEN a=z THEN a ELSE a||' --> '||z END AS delta FROM w WHERE a IS NOT NULL AND z IS NOT NULL",
)
def delta_category(spark, sf_dir):
    return explore.delta_category(fx.results(spark, sf_dir), CAT)


@register(
    "E9_common_dates",
    f"WITH {RES} SELECT DISTINCT date_result FROM res WHERE name='{NUM}' AND date_result IN (SELECT date_result FROM res WHERE name='{CAT}')",
)
def common(spark, sf_dir):
    return explore.common_dates(fx.results(spark, sf_dir), NUM, CAT)


def _hi(alias: str, t: int) -> str:
    return f"CASE WHEN {alias}.value_num>{t} THEN 'High' ELSE 'Low' END"


def _pair(first: str, second: str, left: str, right: str) -> str:
    return (
        f"WITH {RES} SELECT a.id_cell, {left}||' X '||{right} AS crossed FROM res a JOIN res b ON a.id_cell=b.id_cell AND a.{AT} AND b.{AT}"
        f" WHERE a.name='{first}' AND b.name='{second}'"
    )


@register("E10_cross_numeric", _pair(NUM, NUM2, _hi("a", 150), _hi("b", 120)))
def cross_numeric(spark, sf_dir):
    return explore.cross_numeric(fx.results(spark, sf_dir), NUM, NUM2, DAY, 150, 120)


@register("E11_cross_category", _pair(CAT, CAT2, "a.max_cell_prop_value", "b.max_cell_prop_value"))
def cross_category(spark, sf_dir):
    return explore.cross_category(fx.results(spark, sf_dir), CAT, CAT2, DAY)


@register("E12_cross_mixed", _pair(CAT, NUM, "a.max_cell_prop_value", _hi("b", 150)))
def cross_mixed(spark, sf_dir):
    return explore.cross_mixed(fx.results(spark, sf_dir), CAT, NUM, DAY, 150)


@register("E13_parse_dates", f"WITH {RES} SELECT name, id_cell, CAST(date_result AS TIMESTAMP) AS date_result FROM res")
def parse_dates(spark, sf_dir):
    text = fx.results(spark, sf_dir).withColumn("date_result", F.col("date_result").cast("string"))
    return explore.parse_dates(text).select("name", "id_cell", "date_result")
