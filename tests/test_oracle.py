"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect
from oracle.statements import statements

SF_DIR = "/root/testdata/sf0.001"
# The smallest tables hold too few users for a repeated job in a valid document.
MAY_BE_EMPTY = {"duplicate_jobs"}


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(entry._QUERIES))
def test_query_matches_sql(spark, connection, name):
    ((_, problem, count, _),) = compare(spark, connection, SF_DIR, [name])
    assert problem is None
    assert count > 0 or name in MAY_BE_EMPTY


def test_every_query_has_sql():
    assert set(entry._QUERIES) == set(statements())


# The bound of each query asked at a later instant, as its SQL states it.
BOUNDS = {
    "run_metrics_30d_in_february": "AS DATE) - 30",
    "sla_metrics_30d_in_february": "AS DATE) - 30",
    "sla_history_in_february": "AS DATE) - 30",
    "incremental_selection_in_march": "INTERVAL 60 DAY",
    "reconcile_gap_in_march": "INTERVAL 60 DAY",
    "latest_runs_in_march": "AS DATE) - 60",
    "run_history_in_march": "AS DATE) - 60",
    "workflow_status_in_march": "AS DATE) - 60",
    "deadline_status_in_april": "AS DATE) - 100",
}


@pytest.mark.parametrize("name", list(BOUNDS))
@pytest.mark.parametrize("days", [-1, 1])
def test_another_bound_gives_other_rows(name, days):
    bound = BOUNDS[name]
    number = next(part for part in bound.split() if part.isdigit())
    sql = statements()[name]
    moved = sql.replace(bound, bound.replace(number, str(int(number) + days)))
    assert moved != sql
    connection = connect("/root/testdata/sf0.01")
    assert set(connection.execute(sql).fetchall()) != set(connection.execute(moved).fetchall())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
