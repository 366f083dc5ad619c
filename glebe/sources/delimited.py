"""Delimited text sources and column jobs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LoadColumn:
    """One line of a column job."""

    origin_column: str
    column_name: str
    condition: str = ""
    primary_key: bool = False
    description: str = ""


def read_delimited(spark: SparkSession, path: str) -> DataFrame:
    """Header line, ``;`` between fields, ``"`` around them; every field is text."""
    return spark.read.csv(path, sep=";", quote='"', escape='"', header=True, inferSchema=False)


def select_columns(df: DataFrame, columns: Sequence[LoadColumn]) -> DataFrame:
    """The listed columns under their new names."""
    return df.select(*[F.col(f"`{c.origin_column}`").alias(c.column_name) for c in columns])


def load_filter(df: DataFrame, columns: Sequence[LoadColumn]) -> DataFrame:
    """Rows in which every column with a condition equals it as text."""
    for c in columns:
        if c.condition:
            df = df.filter(F.col(f"`{c.origin_column}`").cast("string") == c.condition)
    return df
