"""Session settings the jobs expect; a cluster's own submit settings win over them."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # geometry is heavy per byte: small shuffles still use every core
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
    # rows of geometry take many times the bytes of their packed file, so its size says little about what a broadcast would hold
    "spark.sql.sources.fileCompressionFactor": "10",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings that a session made elsewhere has left open."""
    given = dict(spark.sparkContext.getConf().getAll())
    for k, v in DEFAULTS.items():
        if k not in given:
            spark.conf.set(k, v)
    return spark


def local_session(cores: int = 8, **conf: str) -> SparkSession:
    """Session for tests and the local benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("glebe")
    settings = {
        **DEFAULTS,
        "spark.sql.shuffle.partitions": str(cores),
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the cluster's ``spark.checkpoint.dir``.

    Only a session whose tasks run in the driver's own process gets one of its own where none is named.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"/tmp/checkpoints/{context.applicationId}"


_DROPPED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Spark deletes a query's shuffle files when it ends: nothing reads them once its result is written."""
    before = spark.conf.get(_DROPPED)
    spark.conf.set(_DROPPED, "true")
    try:
        yield
    finally:
        spark.conf.set(_DROPPED, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written in the cluster's shared folder and read again: cuts the lineage."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _storable(kind: T.DataType) -> bool:
    """Whether Parquet gives back a type as it was."""
    if isinstance(kind, T.StructType):
        return bool(kind.fields) and all(_storable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _storable(kind.elementType)
    if isinstance(kind, T.MapType):
        return _storable(kind.keyType) and _storable(kind.valueType)
    plain = (T.NumericType, T.StringType, T.BinaryType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return isinstance(kind, plain)


def cut_lineage(df: DataFrame) -> DataFrame:
    """A result used several times, computed once and stored in the shared folder.

    It is a packed table: a checkpoint's rows take about ten times the disk, and the shuffles behind it would stay.
    """
    if _storable(df.schema) and len({c.lower() for c in df.columns}) == len(df.columns):
        return stored(df, "cut")
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """New folder name in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
