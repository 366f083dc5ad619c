"""Results that are computed once and read several times."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from glebe.functions import geometry as g
from glebe.functions import measure as m
from glebe.session import cut_lineage


def test_a_cut_result_is_a_packed_table(spark):
    """F3 F6 F8: a checkpoint wrote some 300 bytes for a row with a rectangle, and kept the shuffles behind it."""
    n = F.col("id")
    rows = spark.range(20_000).repartition(4).select(
        n.alias("fid"), g.rectangle(40 * (n % 100), 40 * F.floor(n / 100), 40 * (n % 100) + 30, 40 * F.floor(n / 100) + 30).alias("geom")
    )
    cut = cut_lineage(rows)
    files = [f.removeprefix("file://") for f in cut.inputFiles()]
    assert files and sum(os.path.getsize(f) for f in files) < 20 * 20_000
    assert cut.schema.simpleString() == rows.schema.simpleString()
    assert cut.filter(m.area("geom") == 900).count() == 20_000


@pytest.mark.parametrize("value", ["NULL", "named_struct()", "make_interval(0, 1)", "array(NULL)"])
def test_values_no_table_holds_are_kept_as_rows(spark, value):
    kept = cut_lineage(spark.range(3).select("id", F.expr(value).alias("v")))
    assert kept.count() == 3 and len(kept.columns) == 2


def test_columns_of_one_name_are_kept(spark):
    ids = spark.range(3)
    assert cut_lineage(ids.join(ids.withColumnRenamed("id", "k"), F.col("id") == F.col("k")).toDF("a", "A")).count() == 3
