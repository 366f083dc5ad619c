"""Stored tables: replace or append, partition replacement, provenance and update logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)


def as_stored(df: DataFrame, stored: DataFrame) -> DataFrame:
    """Columns cast and ordered like the stored table; columns it lacks are left out.

    A value that does not fit the stored type is an error.
    """
    have = set(df.columns)

    def fitted(f: T.StructField) -> Column:
        if f.name not in have:
            return F.lit(None).cast(f.dataType)
        if df.schema[f.name].dataType == f.dataType:
            return F.col(f.name)
        value = F.col(f.name).try_cast(f.dataType)
        text = F.concat(F.lit(f"{f.name} does not fit {f.dataType.simpleString()}: "), F.col(f.name).cast("string"))
        misfit = F.col(f.name).isNotNull() & value.isNull()
        return F.when(misfit, F.raise_error(text).cast(f.dataType)).otherwise(value)

    return df.select(*[fitted(f).alias(f.name) for f in stored.schema.fields])


def save_table(
    df: DataFrame, path: str, append: bool = False, primary_key: Sequence[str] = ()
) -> None:
    """Create the table anew, or append to it in its own types; keys must stay unique."""
    mode = "append" if append else "overwrite"
    stored = None
    if append:
        stored = df.sparkSession.read.parquet(path)
        df = as_stored(df, stored)
    if primary_key:
        double = duplicate_keys(df, primary_key).first()
        if double is None and stored is not None:
            # the stored keys are unique already
            double = df.select(*primary_key).join(stored.select(*primary_key), list(primary_key), "left_semi").first()
        if double is not None:
            raise ValueError(f"primary key {list(primary_key)} is not unique: {double.asDict()}")
    df.write.mode(mode).parquet(path)


def save_partition(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Rewrite exactly the partitions present in ``df``; a large one is spread over tasks."""
    (
        df.hint("rebalance", *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def replace_partitions(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Rewrite the whole folder: partitions that ``df`` lacks are removed."""
    (
        df.hint("rebalance", *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*keys)
        .parquet(path)
    )


def log_update(rebuilt: DataFrame, kind: str, id_col: str, user: str) -> DataFrame:
    """One log row per (date, id) that was rebuilt."""
    return (
        rebuilt.select("date_result", F.col(id_col).alias("id_updated"))
        .distinct()
        .withColumn("kind", F.lit(kind))
        .withColumn("date_real", F.current_timestamp())
        .withColumn("feeduser", F.lit(user))
    )


def append_log(log: DataFrame, path: str) -> None:
    log.write.mode("append").parquet(path)


def track_table(
    spark: SparkSession,
    schema: str,
    table: str,
    append: bool,
    origin: str,
    srid: int | None,
    description: str,
    user: str,
    score: float | None,
) -> DataFrame:
    """Provenance of one load."""
    row = spark.range(1)
    return row.select(
        F.lit(schema).alias("table_schema"),
        F.lit(table).alias("table_name"),
        F.lit(append).alias("append"),
        F.lit(origin).alias("origin_file"),
        F.lit(srid).cast("int").alias("srid"),
        F.lit(description).alias("description"),
        F.lit(user).alias("feeduser"),
        F.current_timestamp().alias("date_real"),
        F.lit(score).cast("double").alias("score_geom"),
    )


def track_columns(columns: DataFrame, schema: str, table: str, user: str) -> DataFrame:
    """One provenance row per loaded column of a column job."""
    return columns.select(
        F.lit(schema).alias("table_schema"),
        F.lit(table).alias("table_name"),
        "origin_column",
        "column_name",
        F.col("description"),
        F.lit(user).alias("feeduser"),
        F.current_timestamp().alias("date_real"),
    )
