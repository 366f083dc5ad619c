"""Load jobs: delimited files to stored, typed tables with geometry and provenance.

A table job has one line per table (``table_schema``, ``table_name``, ``origin_file``, ``append``, ``dest_srid``,
``proj_init_ifproj``, ``description``), a column job one per column (``table_schema``, ``table_name``, ``origin_column``,
``column_name``, ``condition``, ``primary_key``, ``description``, and for the geometry ``geom_join_on`` with
``ref_geom_table_schema`` and ``ref_geom_table_name``, or ``coordinates_ifproj``: x, y or wkt). A new table's types are
inferred from all its rows; an appended one takes the stored types. Tables lie in ``folder/<schema>/<table>``,
their provenance beside them in ``table_tracks`` and ``column_tracks``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glebe.sources import delimited, sinks, typing, vector


def _said(row: dict, name: str) -> str:
    return (row.get(name) or "").strip()


def _system(job: dict) -> int | str:
    given = _said(job, "proj_init_ifproj")
    return int(given) if given.lstrip("-").isdigit() else given


def with_geometry(df: DataFrame, job: dict, columns: Sequence[dict], folder: str) -> DataFrame:
    """Geometry from a reference table's key, else from x and y, else from text; unchanged without any of them."""
    spark, dest = df.sparkSession, int(_said(job, "dest_srid") or 2154)
    for c in columns:
        if _said(c, "geom_join_on"):
            ref = spark.read.parquet(f"{folder}/{_said(c, 'ref_geom_table_schema')}/{_said(c, 'ref_geom_table_name')}")
            return vector.attach_geom_by_key(df, ref, c["column_name"], _said(c, "geom_join_on"))
    role = {_said(c, "coordinates_ifproj"): c["column_name"] for c in columns if _said(c, "coordinates_ifproj")}
    if "x" in role and "y" in role:
        return vector.attach_geom_xy(df, role["x"], role["y"], _system(job) or 4326, dest)
    if "wkt" in role:
        return vector.read_vector(df, role["wkt"], int(_system(job) or dest), dest)
    return df


def load_table(spark: SparkSession, job: dict, columns: Sequence[dict], folder: str, user: str) -> DataFrame:
    """Loads one table; returns its provenance row, which is appended to the tracks too."""
    schema, table = _said(job, "table_schema"), _said(job, "table_name")
    path, append = f"{folder}/{schema}/{table}", _said(job, "append").lower() == "true"
    mine = [c for c in columns if (_said(c, "table_schema"), _said(c, "table_name")) == (schema, table)]
    if not mine:
        raise ValueError(f"no columns for {schema}.{table}")
    listed = [delimited.LoadColumn(_said(c, "origin_column"), _said(c, "column_name"), _said(c, "condition"),
                                   _said(c, "primary_key").lower() == "true", _said(c, "description")) for c in mine]
    raw = delimited.read_delimited(spark, _said(job, "origin_file"))
    missing = [c.origin_column for c in listed if c.origin_column not in raw.columns]
    if missing:
        raise ValueError(f"{_said(job, 'origin_file')} lacks {missing}")
    rows = delimited.select_columns(delimited.load_filter(raw, listed), listed)
    shapes = {_said(c, "column_name") for c in mine if _said(c, "coordinates_ifproj") in ("x", "y", "wkt")}
    plain = [c.column_name for c in listed if c.column_name not in shapes]
    if append:
        kinds = {f.name: f.dataType.simpleString() for f in spark.read.parquet(path).schema.fields}
        known = {stored: kind for kind, stored in typing.SPARK_TYPE.items()}
        kinds = {n: known.get(kinds.get(n, ""), "text") for n in plain}
    else:
        kinds = typing.infer_types(rows, plain)
    for name, kind in kinds.items():
        rows = typing.cast_typed(rows, name, kind)
    found = with_geometry(rows, job, mine, folder)
    sinks.save_table(found, path, append, [c.column_name for c in listed if c.primary_key])
    stored = spark.read.parquet(path)
    score = vector.geom_score(stored).first()["score_geom"] if "geom" in stored.columns else None
    srid = int(_said(job, "dest_srid")) if _said(job, "dest_srid") else None
    track = sinks.track_table(spark, schema, table, append, _said(job, "origin_file"), srid, _said(job, "description"), user, score)
    sinks.append_log(track, f"{folder}/{schema}/table_tracks")
    named = spark.createDataFrame([(c.origin_column, c.column_name, c.description) for c in listed], "origin_column string, column_name string, description string")
    sinks.append_log(sinks.track_columns(named, schema, table, user), f"{folder}/{schema}/column_tracks")
    return track


def load_tables(tables: DataFrame, columns: DataFrame, folder: str, user: str) -> DataFrame:
    """Runs the lines of a table job one after another (later ones may refer to earlier); a report by line."""
    spark, done = tables.sparkSession, []
    listed = [r.asDict() for r in columns.collect()]
    for row in (r.asDict() for r in tables.collect()):
        name = f"{_said(row, 'table_schema')}.{_said(row, 'table_name')}"
        if _said(row, "go") == "0":
            done.append((name, "skipped", ""))
            continue
        try:
            load_table(spark, row, listed, folder, user)
            done.append((name, "done", ""))
        except (ValueError, PySparkException) as e:
            done.append((name, "failed", str(e).split("\n")[0]))
    return spark.createDataFrame(done, "table string, status string, message string")


def load_job_files(spark: SparkSession, tables: str, columns: str, folder: str, user: str) -> DataFrame:
    return load_tables(delimited.read_delimited(spark, tables), delimited.read_delimited(spark, columns), folder, user)


__all__ = ["load_job_files", "load_table", "load_tables", "with_geometry"]
