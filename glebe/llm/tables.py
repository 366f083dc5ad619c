"""Tables of the language-model operators and intermediate tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glebe.session import shuffles_dropped, stored

__all__ = ["apart", "fold", "join_spread", "released", "shuffles_dropped", "stored", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a missing id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % parts


def apart(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has."""
    have = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in have:
            name = f"_{name}"
        have.add(name.lower())
        out.append(name)
    return out


HOT = 1000


def released(*tables: DataFrame) -> None:
    """Deletes the folders of ``stored`` tables that nothing reads any more."""
    for t in tables:
        context = t.sparkSession.sparkContext
        for folder in {file.rsplit("/", 1)[0] for file in t.inputFiles()}:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def join_spread(left: DataFrame, right: DataFrame, key: str, rows: str) -> DataFrame:
    """Inner join by ``key``, unique in ``right``, where some keys hold a large part of ``left``.

    ``rows`` names the column of ``right`` that says how many rows of ``left`` have the key. Keys with over a
    ``HOT``-th of all rows are fewer than ``HOT``: they travel to the tasks of ``left``, the others are shuffled.
    """
    total = right.agg(F.sum(rows)).first()[0] or 0
    hot = F.col(rows) * HOT > total
    often = F.broadcast(right.filter(hot).drop(rows))
    rest = left.join(F.broadcast(right.filter(hot).select(key)), key, "left_anti")
    return left.join(often, key).unionByName(rest.join(right.filter(~hot).drop(rows), key))
