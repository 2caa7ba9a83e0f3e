"""Every registered query against its SQL; COUNTCAST_SF picks the tables (default sf0.001)."""

import os

import pytest

import __spark_entry__ as entry_point
from tests.compare import connect, mismatch
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF = f"/root/testdata/{os.environ.get('COUNTCAST_SF', 'sf0.001')}"
ROWS_ONLY = {"train_tweedie_glm", "train_poisson_pooled", "train_gbt_pooled"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_entry_point_has_every_query():
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLE) <= set(entry_point.oracle_sql())


def test_every_query_has_sql_or_is_a_fit():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY and not set(ORACLE) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    assert mismatch(spark, con, QUERIES[name], ORACLE[name], SF) is None


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_fit_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert {"prediction", "notify"} <= set(entry_point.entry(spark).columns)
