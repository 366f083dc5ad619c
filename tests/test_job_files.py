"""Job files: shared overlays, conditional aggregates, reports."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks import catalog
from glebe import fixtures as fx
from glebe.operators import modes, results
from glebe.plans import indicator, jobs
from tests.compare import ROOT

SF = f"{ROOT}/sf0.001"


def spec(n, num="", text="", condition="", **more):
    return indicator.IndicatorSpec(n, 1, 1, num, text, condition_variable=condition, kind="polygon", **more)


@pytest.fixture(scope="module")
def tables(spark):
    return fx.cells(spark, SF), catalog._datasets(spark, SF)


def rows(df):
    keys = ("date_result", "id_indicator", "id_cell", "value_str", "value_num")
    return sorted(tuple(str(r[k]) if k != "value_num" or r[k] is None else f"{r[k]:.9f}" for k in keys) for r in df.collect())


def test_conditional_aggregates_equal_single_builds(spark, tables):
    cells, data = tables
    polygons = data.filter("id_variable = 1").limit(400).checkpoint()
    specs = []
    for n, mode in enumerate(modes.MODES):
        is_text = mode in ("plus_stats", "value_str_mode_inter", "value_full", "value_str_full", "value_num_agg", "value_str_agg")
        specs.append(spec(n, "" if is_text else mode, mode if is_text else "", ("", "value_num >= 50", "value_str LIKE '1%' OR year(date_result) = 1996")[n % 3]))
    together = jobs.shared_indicators(cells, polygons, specs)
    alone = [indicator.compute_indicator(cells, polygons, s) for s in specs]
    union = alone[0]
    for a in alone[1:]:
        union = union.unionByName(a)
    assert rows(together) == rows(union)


def test_one_overlay_serves_a_group(spark, tables):
    cells, data = tables
    found = jobs.shared_indicators(cells, data.filter("id_variable = 1"), [spec(1, "ct_elt"), spec(2, "prop_surf", condition="value_num > 3"), spec(3, "", "value_str_agg")])
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Join ") == 1


def test_what_cannot_share_runs_apart(spark, tables):
    _, data = tables
    data = data.withColumn("info", F.lit("x"))
    made = [
        jobs.IndicatorJob(str(n), go, None, s)
        for n, (go, s) in enumerate([
            ("1", spec(1, "ct_elt")), ("1", spec(2, "val_sum", condition="value_num > 1")), ("1", spec(3, "val_sum", condition="info = 'x'")),
            ("2", spec(4, "val_sum")), ("1", spec(5, "value_invdist_pt#4")), ("1", spec(6, "ct_elt", per_feature=True)),
        ])
    ]
    assert [[j.spec.id_indicator for j in g] for g in jobs.compiled(made, data)] == [[1, 2], [3], [4], [5], [6]]


def test_report_and_pivots(spark):
    found, known, report, pivots = catalog.job_run(spark, SF)
    got = {r["name"]: (r["status"], r["shared"]) for r in report.collect()}
    assert got == {"share": ("done", 2), "count": ("done", 2), "highest": ("done", 1), "resumed": ("done", 1), "idle": ("skipped", 0),
                   "broken": ("failed", 0), "odd": ("failed", 0), "unread": ("failed", 0)}
    ids = {r["name"]: r["id_indicator"] for r in known.collect()}
    assert ids["older"] == 5 and len(set(ids.values())) == len(ids) and "idle" not in ids
    for name in (f"num_{ids['share']}", f"str_{ids['share']}", f"num_{ids['share']}_2", f"num_{ids['highest']}"):
        assert spark.read.parquet(f"{pivots}/{name}").columns[:1] in (["id_cell"], ["cell_code"])


def test_one_line_that_fails_when_run_does_not_stop_its_group(spark, tables, tmp_path):
    cells, data = tables
    lines = [("good", "ct_elt", ""), ("bad", "val_sum", "1 / (value_num - value_num) > 0"), ("fine", "val_max", "value_num > 3")]
    config = spark.createDataFrame([(n, "v", "g", m, "", c, "", "1") for n, m, c in lines], ", ".join(f"{c} string" for c in catalog.JOB_HEAD.split(";")))
    names = spark.createDataFrame([(1, "v")], "id_variable long, name string"), spark.createDataFrame([(1, "g")], "id_grid int, name string")
    known = spark.createDataFrame([], "id_indicator long, name string")
    _, report = jobs.run_jobs(config, cells, data, *names, known, f"{tmp_path}/r", f"{tmp_path}/l", f"{tmp_path}/p", "me", kind="polygon")
    assert [(r["name"], r["status"]) for r in report.collect()] == [("good", "done"), ("bad", "failed"), ("fine", "done")]
    assert results.has_values(spark.read.parquet(f"{tmp_path}/r"), "num")
