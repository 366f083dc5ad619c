"""Runs of indicator jobs from a configuration table.

A job file has one line per indicator (``;`` between fields): ``name``, ``work_variable``, ``work_grid``, ``num_mode``,
``str_mode``, ``condition_variable``, ``exploits_grid`` and ``go`` (0 skips the line, 1 builds it anew, 2
resumes it). The lines are compiled before anything runs: those that read the same variable on the same grid
share one overlay, and every mode under every condition becomes a conditional aggregate on it. So a file of a hundred
indicators of one variable costs one spatial join. A condition that reads more than value and date, and a mode of
points that needs its own search, cannot share; such lines run alone.

A line that cannot run (unknown variable, grid or mode, a condition that does not parse) is reported and the others run;
if a shared plan fails, its lines are run one by one, so that one line's values cannot stop another.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glebe.operators import modes, results, stats
from glebe.operators.grids import upsert_ref
from glebe.plans import indicator as plan
from glebe.session import cut_lineage
from glebe.sources.delimited import read_delimited

SKIP, REBUILD, RESUME = "0", "1", "2"
#: what a shared overlay still knows of an observation
KEPT = ("date_result", "value_num", "value_str")


class JobError(ValueError):
    """A line of a job file that cannot run."""


@dataclass(frozen=True)
class IndicatorJob:
    """A line of a job file with its names resolved."""

    name: str
    go: str
    exploits_grid: int | None
    spec: plan.IndicatorSpec


@dataclass(frozen=True)
class JobReport:
    """What became of a line: ``done``, ``skipped``, ``complete`` (nothing to resume) or ``failed``."""

    name: str
    id_indicator: int | None
    status: str
    shared: int  # lines that ran in the same plan
    message: str = ""


REPORT = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("id_indicator", T.LongType()), T.StructField("status", T.StringType()),
    T.StructField("shared", T.IntegerType()), T.StructField("message", T.StringType()),
])


def _known(names: DataFrame, id_col: str, wanted: Sequence[str]) -> dict[str, int]:
    """Ids of the names a job file mentions."""
    rows = names.filter(F.col("name").isin(list(wanted))).groupBy("name").agg(F.min(id_col).alias("id")).collect()
    return {r["name"]: r["id"] for r in rows}


def _message(e: Exception) -> str:
    return str(e).split("\n")[0]


def _checked(row: dict, ids: dict[str, int], variables: dict[str, int], grids: dict[str, int], datasets: DataFrame, defaults: dict) -> IndicatorJob:
    said = {k: (v or "").strip() for k, v in row.items()}
    if said["go"] not in (REBUILD, RESUME):
        raise JobError(f"go must be 0, 1 or 2, not {said['go']!r}")
    for kind, name, known in (("variable", said["work_variable"], variables), ("grid", said["work_grid"], grids)):
        if name not in known:
            raise JobError(f"unknown {kind}: {name!r}")
    exploits = said.get("exploits_grid", "")
    if exploits and exploits not in grids:
        raise JobError(f"unknown grid: {exploits!r}")
    for mode in (said["num_mode"], said["str_mode"]):
        if mode and mode not in modes.MODES and mode not in plan.MAJORITY and not mode.startswith(plan.NEAREST):
            raise JobError(f"unknown aggregation mode: {mode!r}")
    if said["condition_variable"]:
        datasets.filter(F.expr(said["condition_variable"])).schema  # analysed here, run nowhere
    spec = plan.IndicatorSpec(
        ids[said["name"]], variables[said["work_variable"]], grids[said["work_grid"]], said["num_mode"], said["str_mode"],
        condition_variable=said["condition_variable"], **defaults,
    )
    return IndicatorJob(said["name"], said["go"], grids.get(exploits), spec)


def _shares(spec: plan.IndicatorSpec, datasets: DataFrame) -> bool:
    """Whether the spec can be an aggregate on an overlay of the whole variable."""
    if spec.num_mode.startswith(plan.NEAREST) or spec.str_mode in plan.MAJORITY:
        return False
    if not spec.condition_variable:
        return True
    # a selection would let the filter see the columns it drops
    kept = datasets.sparkSession.createDataFrame([], T.StructType([datasets.schema[c] for c in KEPT]))
    try:
        kept.filter(F.expr(spec.condition_variable)).schema
    except PySparkException:
        return False
    return True


def compiled(jobs: Sequence[IndicatorJob], datasets: DataFrame) -> list[list[IndicatorJob]]:
    """Jobs that share a plan stand together; rebuilt and resumed ones apart, as these read some dates only."""
    groups: dict[tuple, list[IndicatorJob]] = {}
    for job in jobs:
        s = job.spec
        key = (s.id_variable, s.id_grid, s.per_feature, job.go)
        groups.setdefault(key if _shares(s, datasets) else (*key, s.id_indicator), []).append(job)
    return list(groups.values())


def shared_indicators(cells: DataFrame, data: DataFrame, specs: Sequence[plan.IndicatorSpec]) -> DataFrame:
    """Results of several specifications of one variable and grid from one overlay."""
    first = specs[0]
    kind = first.kind or plan.geometry_kind(data)
    if kind is None:
        raise JobError(f"no geometry to compute indicator {first.id_indicator} from")
    conditions = [F.expr(s.condition_variable) if s.condition_variable else F.lit(True) for s in specs]
    if all(s.condition_variable for s in specs):
        anyone = conditions[0]
        for c in conditions[1:]:
            anyone = anyone | c
        data = data.filter(anyone)

    def each(found: DataFrame, keys: Sequence[str]) -> DataFrame:
        columns = []
        for i, (s, only) in enumerate(zip(specs, conditions)):
            columns += [
                F.count(F.when(only, 1)).alias(f"n_{i}"),
                modes.mode_column(s.num_mode, "double", only).alias(f"num_{i}"),
                modes.mode_column(s.str_mode.strip(), "string", only).alias(f"str_{i}"),
            ]
        return found.groupBy(*keys).agg(*columns)

    if kind == "point":
        wrong = {m for s in specs for m in (s.num_mode, s.str_mode) if m in modes.SHARE_MODES}
        if wrong:
            raise JobError(f"modes without a meaning for points: {sorted(wrong)}")
        wide = stats.per_cell(cells, data, first.cell_size, first.tile, each)
    else:
        overlay = stats.polygon_stats if kind == "polygon" else stats.line_stats
        how = "feature" if first.per_feature else "value"
        # one plan for the group of jobs, unless they expect hot groups
        found = overlay(cells, data, first.tile, how, first.hot_rows, lazy=first.hot_rows is None)
        wide = each(found, ["id_cell", "date_result"])
    rows = F.array(*[
        F.struct(
            F.lit(s.id_indicator).cast("bigint").alias("id_indicator"), F.col(f"n_{i}").alias("n"),
            F.col(f"str_{i}").alias("value_str"), F.col(f"num_{i}").alias("value_num"),
        ) for i, s in enumerate(specs)
    ])
    long = wide.select("date_result", "id_cell", F.inline(F.filter(rows, lambda r: r["n"] > 0)))
    return long.select("date_result", "id_indicator", "id_cell", "value_str", "value_num")


def _line_shares_total(kind: str | None, specs: Sequence[plan.IndicatorSpec]) -> bool:
    """Shares of lines are taken of all length that passes the condition, so conditions must agree."""
    return kind != "line" or len({s.condition_variable for s in specs}) == 1


def _built(group: Sequence[IndicatorJob], cells: DataFrame, datasets: DataFrame, existing: DataFrame | None) -> DataFrame:
    specs = [j.spec for j in group]
    grid, data = cells.filter(F.col("id_grid") == specs[0].id_grid), datasets.filter(F.col("id_variable") == specs[0].id_variable)
    if len(group) == 1:
        return plan.build_indicator(cells, datasets, specs[0], existing if group[0].go == RESUME else None)
    kind = specs[0].kind or plan.geometry_kind(data)
    specs = [replace(s, kind=kind) for s in specs]
    if existing is None or group[0].go == REBUILD:
        return shared_indicators(grid, data, specs)
    # dates at which some indicator misses a cell that meets data; each takes its own of them
    met = cut_lineage(_met(grid, data, specs, kind))
    done = existing.filter(F.col("id_indicator").isin([s.id_indicator for s in specs])).select("id_indicator", "id_cell", "date_result").distinct()
    open_dates = cut_lineage(met.join(done, ["id_indicator", "id_cell", "date_result"], "left_anti").select("id_indicator", "date_result").distinct())
    some = data.join(open_dates.select("date_result").distinct(), "date_result", "left_semi")
    return shared_indicators(grid, some, specs).join(open_dates, ["id_indicator", "date_result"], "left_semi")


def _met(grid: DataFrame, data: DataFrame, specs: Sequence[plan.IndicatorSpec], kind: str) -> DataFrame:
    """(indicator, cell, date) that meet data: the overlay with counts only."""
    counted = [replace(s, num_mode="ct_elt", str_mode="", kind=kind) for s in specs]
    return shared_indicators(grid, data, counted).select("id_indicator", "id_cell", "date_result")


def run_jobs(
    config: DataFrame, cells: DataFrame, datasets: DataFrame, variables: DataFrame, grids: DataFrame, indicators: DataFrame,
    results_path: str, log_path: str, exploits_path: str, user: str, **defaults,
) -> tuple[DataFrame, DataFrame]:
    """Runs the lines of a job file; returns the indicators with the new names, and a report by line.

    ``variables``, ``grids`` and ``indicators`` give ids (``id_variable``, ``id_grid``, ``id_indicator``) by ``name``;
    results are published in ``results_path`` by indicator and date, with a line in the log for each, and
    pivots by date in ``exploits_path`` (``num_<id>`` and ``str_<id>``, and with ``exploits_grid`` the same on its cells).
    """
    spark = config.sparkSession
    rows = [r.asDict() for r in config.collect()]
    report = [JobReport(r["name"], None, "skipped", 0) for r in rows if (r["go"] or "").strip() == SKIP]
    rows = [r for r in rows if (r["go"] or "").strip() != SKIP]
    names = [(r["name"] or "").strip() for r in rows]
    wanted = spark.createDataFrame([(n,) for n in dict.fromkeys(names) if n], "name string")
    indicators = cut_lineage(upsert_ref(indicators, wanted, "name", "id_indicator"))
    ids = _known(indicators, "id_indicator", names)
    known_variables = _known(variables, "id_variable", [(r["work_variable"] or "").strip() for r in rows])
    known_grids = _known(grids, "id_grid", [(r[c] or "").strip() for r in rows for c in ("work_grid", "exploits_grid") if c in r])
    jobs: list[IndicatorJob] = []
    for name, row in zip(names, rows):
        try:
            if not name or any(j.name == name for j in jobs):
                raise JobError(f"a line needs a name of its own, not {name!r}")
            jobs.append(_checked(row, ids, known_variables, known_grids, datasets, defaults))
        except (JobError, PySparkException) as e:
            report.append(JobReport(name, ids.get(name), "failed", 0, _message(e)))

    waiting = compiled(jobs, datasets)
    while waiting:
        group = waiting.pop(0)
        kind = plan.geometry_kind(datasets.filter(F.col("id_variable") == group[0].spec.id_variable)) if len(group) > 1 else None
        if not _line_shares_total(kind, [j.spec for j in group]):
            apart: dict[str, list[IndicatorJob]] = {}
            for job in group:
                apart.setdefault(job.spec.condition_variable, []).append(job)
            waiting = [*apart.values(), *waiting]
            continue
        try:
            report += _published(spark, group, cells, datasets, results_path, log_path, exploits_path, user)
        except (JobError, ValueError, PySparkException) as e:
            if len(group) > 1:
                waiting = [[job] for job in group] + waiting
            else:
                report.append(JobReport(group[0].name, group[0].spec.id_indicator, "failed", 1, _message(e)))
    order = {(r["name"] or "").strip(): i for i, r in enumerate(config.collect())}
    report.sort(key=lambda r: order.get(r.name, -1))
    return indicators, spark.createDataFrame([(r.name, r.id_indicator, r.status, r.shared, r.message) for r in report], REPORT)


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The published results, or None before the first ones."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(where):
        return None
    return spark.read.parquet(path).withColumns({"id_indicator": F.col("id_indicator").cast("bigint"), "date_result": F.col("date_result").cast("date")})


def _published(
    spark: SparkSession, group: Sequence[IndicatorJob], cells: DataFrame, datasets: DataFrame, results_path: str, log_path: str,
    exploits_path: str, user: str,
) -> list[JobReport]:
    before = _stored(spark, results_path)
    found = cut_lineage(_built(group, cells, datasets, before if group[0].go == RESUME else None))
    found = found.withColumn("date_result", F.col("date_result").cast("date"))
    fresh = {r[0] for r in found.select("id_indicator").distinct().collect()}
    rebuilt = [j.spec.id_indicator for j in group if j.go == REBUILD and (before is not None or j.spec.id_indicator in fresh)]
    if fresh or rebuilt:
        plan.publish(found, results_path, log_path, user, rebuilt)
    out = []
    for job in group:
        id_indicator = job.spec.id_indicator
        if id_indicator in fresh:
            _exploit(_stored(spark, results_path).filter(F.col("id_indicator") == id_indicator), cells, job, exploits_path)
        out.append(JobReport(job.name, id_indicator, "done" if id_indicator in fresh or job.go == REBUILD else "complete", len(group)))
    return out


def _exploit(found: DataFrame, cells: DataFrame, job: IndicatorJob, path: str) -> None:
    """Pivots by date, on the job's grid and on the one it names."""
    mine = cells.filter(F.col("id_grid") == job.spec.id_grid)
    dates: list[dt.date] = results.result_dates(found)
    for kind in ("num", "str"):
        wide = results.pivot_results(found, mine, kind, dates)
        if wide is None:
            continue
        results.save_pivot(wide, f"{path}/{kind}_{job.spec.id_indicator}")
        if job.exploits_grid is not None:
            results.save_pivot(results.pivot_on_grid(wide, cells, job.exploits_grid), f"{path}/{kind}_{job.spec.id_indicator}_{job.exploits_grid}")


def run_job_file(spark: SparkSession, path: str, *tables: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """``run_jobs`` on a delimited file."""
    return run_jobs(read_delimited(spark, path), *tables, **options)
