"""Every registered query against plain SQL on the same tables, and every registered query on its own."""

import os

import __spark_entry__ as contract
import compare
import pytest

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = contract._core_queries()
SQL = {name: sql for name, sql in contract.oracle_sql().items() if name in QUERIES}

pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def connection():
    return compare.oracle(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, connection, name):
    assert compare.difference(QUERIES[name](spark, SF), connection, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql_finds_something(connection, name):
    """A query that compares nothing with nothing, or only zeros with zeros, tests nothing."""
    rows = connection.execute(SQL[name]).fetchall()
    assert rows and any(value not in (0, None) for row in rows for value in row)


def test_untyped_counts_are_not_zero(connection):
    assert min(connection.execute(SQL["untyped_counts"]).fetchone()[:2]) > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_approximate_users_are_close(spark):
    metrics = contract._event_metrics(spark, SF)
    exact = {row.date: row.dau for row in metrics.get_dau().collect()}
    close = {row.date: row.dau for row in metrics.get_approx_dau().collect()}
    assert exact.keys() == close.keys()
    assert all(abs(close[on] - exact[on]) <= max(1, 0.15 * exact[on]) for on in exact)


def test_checks_find_both_outcomes(spark):
    for name in ("count_check", "overlap_check"):
        assert {row.passed for row in QUERIES[name](spark, SF).collect()} == {True, False}


def test_entry_runs(spark):
    rows = contract.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {
        "start_rank", "horizon", "upgrade_rate", "downgrade_rate", "cohort_size"
    }
