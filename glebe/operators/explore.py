"""Slicing, thresholding, differencing and crossing of published indicators.

Frames are long: ``name, date_result, id_cell, value_num, value_str, max_cell_prop_value``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CATEGORY = "max_cell_prop_value"


def indicator_kinds(df: DataFrame) -> DataFrame:
    """Numeric when any value is a number, else categorical."""
    has = F.max(F.col("value_num").isNotNull())
    return df.groupBy("name").agg(
        F.when(has, F.lit("numeric")).otherwise(F.lit("categorical")).alias("kind")
    )


def indicator_dates(df: DataFrame) -> DataFrame:
    return df.groupBy("name").agg(F.array_sort(F.collect_set("date_result")).alias("dates"))


def category_domain(df: DataFrame) -> DataFrame:
    """Sorted categories of each categorical indicator."""
    return df.groupBy("name").agg(F.array_sort(F.collect_set(CATEGORY)).alias("categories")).filter(
        F.size("categories") > 0
    )


def indicator_at(df: DataFrame, name: str, date: dt.date, kind: str) -> DataFrame:
    """One indicator at one date, without missing values."""
    value = "value_num" if kind == "numeric" else CATEGORY
    here = (F.col("name") == name) & (F.col("date_result") == F.lit(date))
    return df.filter(here & F.col(value).isNotNull())


def level(value: Column, t: float) -> Column:
    return F.when(value > t, F.lit("High")).otherwise(F.lit("Low"))


def threshold(df: DataFrame, name: str, date: dt.date, t: float) -> DataFrame:
    at = indicator_at(df, name, date, "numeric")
    return at.withColumn("threshold_value", level(F.col("value_num"), t))


def threshold_range(df: DataFrame, name: str, date: dt.date) -> DataFrame:
    """Bounds, start and step of a threshold slider."""
    v = F.col("value_num")
    return (
        indicator_at(df, name, date, "numeric")
        .agg(F.min(v).alias("low"), F.max(v).alias("high"))
        .withColumn("start", (F.col("high") - F.col("low")) / 2)
        .withColumn("step", (F.col("high") - F.col("low")) / 10)
    )


def _first_last(df: DataFrame, name: str, value: str) -> DataFrame:
    """Values of each cell at the indicator's first and last date, when these differ."""
    one = df.filter((F.col("name") == name) & F.col(value).isNotNull())
    span = one.agg(F.min("date_result").alias("d0"), F.max("date_result").alias("d1")).filter(
        F.col("d0") < F.col("d1")
    )
    # a single row of bounds
    dated = one.join(F.broadcast(span), F.col("date_result").between(F.col("d0"), F.col("d1")))
    return dated.groupBy("id_cell").agg(
        F.max(F.when(F.col("date_result") == F.col("d0"), F.col(value))).alias("first_value"),
        F.max(F.when(F.col("date_result") == F.col("d1"), F.col(value))).alias("last_value"),
    )


def delta_numeric(df: DataFrame, name: str) -> DataFrame:
    """Last minus first value per cell; NULL when a cell lacks one of them."""
    return _first_last(df, name, "value_num").select(
        "id_cell", (F.col("last_value") - F.col("first_value")).alias("delta")
    )


def delta_category(df: DataFrame, name: str) -> DataFrame:
    """``a --> b`` per cell, or ``a`` when unchanged; incomplete cells are left out."""
    a, b = F.col("first_value"), F.col("last_value")
    return (
        _first_last(df, name, CATEGORY)
        .filter(a.isNotNull() & b.isNotNull())
        .select("id_cell", F.when(a == b, a).otherwise(F.concat_ws(" --> ", a, b)).alias("delta"))
    )


def common_dates(df: DataFrame, first: str, second: str) -> DataFrame:
    def dates(n: str) -> DataFrame:
        return df.filter(F.col("name") == n).select("date_result")

    return dates(first).intersect(dates(second))


def _cross(a: DataFrame, b: DataFrame, left: Column, right: Column) -> DataFrame:
    one = a.select("id_cell", left.alias("left_value"))
    two = b.select("id_cell", right.alias("right_value"))
    return one.join(two, "id_cell").select(
        "id_cell", F.concat_ws(" X ", "left_value", "right_value").alias("crossed")
    )


def cross_numeric(
    df: DataFrame, first: str, second: str, date: dt.date, t1: float, t2: float
) -> DataFrame:
    """``High``/``Low`` of two numeric indicators for cells that have both."""
    v = F.col("value_num")
    return _cross(
        indicator_at(df, first, date, "numeric"),
        indicator_at(df, second, date, "numeric"),
        level(v, t1),
        level(v, t2),
    )


def cross_category(df: DataFrame, first: str, second: str, date: dt.date) -> DataFrame:
    c = F.col(CATEGORY)
    return _cross(
        indicator_at(df, first, date, "categorical"),
        indicator_at(df, second, date, "categorical"),
        c,
        c,
    )


def cross_mixed(df: DataFrame, category: str, numeric: str, date: dt.date, t: float) -> DataFrame:
    return _cross(
        indicator_at(df, category, date, "categorical"),
        indicator_at(df, numeric, date, "numeric"),
        F.col(CATEGORY),
        level(F.col("value_num"), t),
    )


def parse_dates(df: DataFrame, col: str = "date_result") -> DataFrame:
    """Text dates as timestamps."""
    return df.withColumn(col, F.to_timestamp(F.col(col)))
