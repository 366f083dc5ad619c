"""Test layers computed from the given tables with integer-metre shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glebe.functions import geometry as g

CELL = 200
WIDTH = 4000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def domain_rows(spark: SparkSession, sf_dir: str) -> int:
    """Parcel rows of the domain: one per hundred orders."""
    return -(-table(spark, sf_dir, "orders").count() // 100)


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """200 m squares over the domain."""
    across = WIDTH // CELL
    down = -(-domain_rows(spark, sf_dir) // 5)
    i = F.col("id")
    cx, cy = i % across, F.floor(i / across)
    x, y = cx * CELL, cy * CELL
    return spark.range(across * down).select(
        (i + 1).alias("id_cell"),
        F.concat(F.lit("E"), cx.cast("string"), F.lit("N"), cy.cast("string")).alias("cell_code"),
        F.lit(1).alias("id_grid"),
        g.rectangle(x, y, x + CELL, y + CELL).alias("geom"),
    )


def _boxed(df: DataFrame, x: Column, y: Column, w: Column, h: Column) -> DataFrame:
    return df.withColumn("geom", g.rectangle(x, y, x + w, y + h))


def _block(k: Column) -> tuple[Column, Column]:
    return 40 * (k % 100), 40 * F.floor(k / 100)


def parcels_a(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    k = F.col("o_orderkey")
    bx, by = _block(k)
    x, y = bx + 5 * ((k * 7919) % 3), by + 5 * ((k * 104729) % 3)
    src = table(spark, sf_dir, "orders").select(k.alias("fid"), "o_orderkey", *keep)
    w, h = 30 + 5 * ((k * 31) % 5), 30 + 5 * ((k * 17) % 5)
    return _boxed(src, x, y, w, h).drop("o_orderkey")


def parcels_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    bx, by = _block(k)
    x, y = bx + 5 * ((k * 13) % 4), by + 5 * ((k * 29) % 4)
    src = table(spark, sf_dir, "orders").filter(k % 7 != 0).select(k.alias("fid"), "o_orderkey")
    w, h = 20 + 5 * ((k * 7) % 7), 20 + 5 * ((k * 11) % 7)
    return _boxed(src, x, y, w, h).drop("o_orderkey")


def poly_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polygon variable: one date per order year."""
    src = parcels_a(spark, sf_dir, "o_orderdate", "o_custkey", "o_orderpriority")
    return src.select(
        F.to_date(F.date_trunc("year", "o_orderdate")).alias("date_result"),
        (F.col("o_custkey") % 100).cast("double").alias("value_num"),
        F.col("o_orderpriority").alias("value_str"),
        "geom",
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line variable: horizontal for even customers, vertical for odd ones, one date."""
    rows = domain_rows(spark, sf_dir)
    c = F.col("c_custkey")
    x, y = 5 * ((c * 7919) % 800), 5 * ((c * 31) % (8 * rows))
    n = 5 * (20 + c % 100)
    flat = c % 2 == 0
    return table(spark, sf_dir, "customer").select(
        F.lit("2020-01-01").cast("date").alias("date_result"),
        (c % 50).cast("double").alias("value_num"),
        F.col("c_mktsegment").alias("value_str"),
        g.segment(
            x.cast("double"),
            y.cast("double"),
            F.when(flat, x + n).otherwise(x).cast("double"),
            F.when(flat, y).otherwise(y + n).cast("double"),
        ).alias("geom"),
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point variable: one date per day; some points lie exactly on cell borders."""
    rows = domain_rows(spark, sf_dir)
    e = F.col("event_id")
    x, y = (e * 7919) % WIDTH, (e * 104729) % (40 * rows)
    return table(spark, sf_dir, "events").select(
        e.alias("point_id"),
        F.to_date("ts").alias("date_result"),
        F.col("value").cast("decimal(12,2)").cast("double").alias("value_num"),
        F.col("event_type").alias("value_str"),
        g.xy_point(x, y).alias("geom"),
    )


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """40 m pixels with four bands."""
    k, cust = F.col("o_orderkey"), F.col("o_custkey")
    bands = [(k * 7919) % 256, (k * 104729) % 256, (cust * 31) % 256, (k * 17 + cust) % 256]
    return table(spark, sf_dir, "orders").select(
        F.lit(1).alias("scene"),
        F.floor(k / 100).alias("row"),
        (k % 100).alias("col"),
        F.array(*[b.cast("double") for b in bands]).alias("b"),
    )


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long indicator table: three numeric and two categorical indicators."""
    grouped = (
        table(spark, sf_dir, "orders")
        .groupBy(
            F.col("o_orderpriority").alias("name"),
            F.make_date(F.year("o_orderdate"), F.lit(1), F.lit(1)).alias("date_result"),
            (F.col("o_custkey") % 50).alias("id_cell"),
        )
        .agg(F.sum(F.col("o_custkey") % 100).cast("double").alias("total"))
    )
    text = F.col("name").isin("1-URGENT", "5-LOW")
    label = F.concat(F.lit("C"), (F.col("total") % 3).cast("bigint").cast("string"))
    return grouped.select(
        "name",
        "date_result",
        "id_cell",
        F.when(~text, F.col("total")).alias("value_num"),
        F.when(text, label).alias("value_str"),
        F.when(text, label).alias("max_cell_prop_value"),
    )


# The same layers for the SQL check, as common table expressions.
SQL = {
    "dom": "dom AS (SELECT CAST(ceil(count(*)/100.0) AS BIGINT) AS nr FROM orders)",
    "cells": """cells AS (
  SELECT cy*20+cx+1 AS id_cell, 'E'||cx||'N'||cy AS cell_code, 200*cx AS cx0, 200*cy AS cy0, 200*cx+200 AS cx1, 200*cy+200 AS cy1
  FROM (SELECT i%20 AS cx, i//20 AS cy FROM (SELECT unnest(range(0, 20*((nr+4)//5))) AS i FROM dom)))""",
    "pa": """pa AS (
  SELECT *, x0+w AS x1, y0+h AS y1 FROM (
  SELECT o_orderkey AS fid, o_custkey, o_orderdate, o_orderpriority,
    40*(o_orderkey%100)+5*((o_orderkey*7919)%3) AS x0, 40*(o_orderkey//100)+5*((o_orderkey*104729)%3) AS y0,
    30+5*((o_orderkey*31)%5) AS w, 30+5*((o_orderkey*17)%5) AS h FROM orders))""",
    "pb": """pb AS (
  SELECT *, x0+w AS x1, y0+h AS y1 FROM (
  SELECT o_orderkey AS fid,
    40*(o_orderkey%100)+5*((o_orderkey*13)%4) AS x0, 40*(o_orderkey//100)+5*((o_orderkey*29)%4) AS y0,
    20+5*((o_orderkey*7)%7) AS w, 20+5*((o_orderkey*11)%7) AS h FROM orders WHERE o_orderkey%7<>0))""",
    "poly": """poly AS (
  SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS date_result, CAST(o_custkey%100 AS DOUBLE) AS value_num,
    o_orderpriority AS value_str, x0, y0, x1, y1, CAST(w*h AS DOUBLE) AS var_area, fid FROM pa)""",
    "lines": """lines AS (
  SELECT DATE '2020-01-01' AS date_result, CAST(c%50 AS DOUBLE) AS value_num, value_str, n, c,
    x AS x0, y AS y0, CASE WHEN c%2=0 THEN x+n ELSE x END AS x1, CASE WHEN c%2=0 THEN y ELSE y+n END AS y1
  FROM (SELECT c_custkey AS c, c_mktsegment AS value_str, 5*((c_custkey*7919)%800) AS x, 5*((c_custkey*31)%(8*nr)) AS y, 5*(20+c_custkey%100) AS n
        FROM customer, dom))""",
    "pts": """pts AS (
  SELECT event_id AS point_id, CAST(ts AS DATE) AS date_result, CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) AS value_num,
    event_type AS value_str, (event_id*7919)%4000 AS x, (event_id*104729)%(40*nr) AS y FROM events, dom)""",
    "px": """px AS (
  SELECT o_orderkey//100 AS r, o_orderkey%100 AS c, CAST((o_orderkey*7919)%256 AS DOUBLE) AS b1, CAST((o_orderkey*104729)%256 AS DOUBLE) AS b2,
    CAST((o_custkey*31)%256 AS DOUBLE) AS b3, CAST((o_orderkey*17+o_custkey)%256 AS DOUBLE) AS b4 FROM orders)""",
    "res": """res AS (
  SELECT name, date_result, id_cell, CASE WHEN name NOT IN ('1-URGENT','5-LOW') THEN total END AS value_num,
    CASE WHEN name IN ('1-URGENT','5-LOW') THEN 'C'||CAST(CAST(total AS BIGINT)%3 AS VARCHAR) END AS value_str,
    CASE WHEN name IN ('1-URGENT','5-LOW') THEN 'C'||CAST(CAST(total AS BIGINT)%3 AS VARCHAR) END AS max_cell_prop_value
  FROM (SELECT o_orderpriority AS name, make_date(CAST(year(o_orderdate) AS INT),1,1) AS date_result, o_custkey%50 AS id_cell, CAST(sum(o_custkey%100) AS DOUBLE) AS total
        FROM orders GROUP BY ALL))""",
}

_NEEDS = {"cells": ["dom"], "poly": ["pa"], "lines": ["dom"], "pts": ["dom"]}


def ctes(*names: str) -> str:
    """``WITH`` list of the named layers and what they need, without the keyword."""
    order: list[str] = []
    for n in names:
        for need in [*_NEEDS.get(n, []), n]:
            if need not in order:
                order.append(need)
    return ",\n".join(SQL[n] for n in order)
