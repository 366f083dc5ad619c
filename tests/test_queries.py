"""Registered queries against their SQL at the smallest scale.

The quick groups run by default; ``GLEBE_FULL=1`` runs every query.
"""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tests.compare import ROOT, difference, duck, types

QUICK = ("E", "R5", "R6", "R7", "S6", "S7", "S9", "S10", "S15", "J7", "J13", "J14", "X1", "X2", "X4", "X5", "C4", "C5",
         "J5", "I3", "G8", "I1_", "T5", "P6", "J6")
SF_DIR = f"{ROOT}/sf0.001"
NAMES = [
    n for n in entry.oracle_sql() if os.environ.get("GLEBE_FULL") or n.startswith(QUICK)
]


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    rel = con.sql(entry.oracle_sql()[name])
    assert types(df, rel) is None
    assert difference(df.columns, [tuple(r) for r in df.collect()], rel.columns, rel.fetchall()) is None


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_gives_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
