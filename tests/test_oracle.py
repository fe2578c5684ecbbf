"""Every registered query against its SQL twin on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import check_oracle  # noqa: E402

import __spark_entry__ as entry_module  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return check_oracle.duck(FOLDER)


def test_entry_runs(spark):
    assert entry_module.entry(spark).count() > 0


def test_every_twin_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLE])
def test_query_equals_sql(spark, con, name):
    ok, text = check_oracle.compare(spark, con, FOLDER, name, QUERIES[name], ORACLE[name])
    assert ok, text  # an empty result fails too
