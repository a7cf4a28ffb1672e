"""Every query that has SQL gives the same rows as DuckDB."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import connect, differences
from conftest import MIDDLE, SMALL

# Their dummy columns are named after the countries of that folder.
ON_MIDDLE = {"regression_frame", "regression_frame_thresholds"}


@pytest.fixture(scope="module")
def connections():
    return {folder: connect(folder) for folder in (SMALL, MIDDLE)}


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, connections, name):
    folder = MIDDLE if name in ON_MIDDLE else SMALL
    df = queries()[name](spark, folder)
    rows = [tuple(r) for r in df.collect()]
    result = connections[folder].execute(oracle_sql()[name])
    assert differences(df.columns, rows, [d[0] for d in result.description], result.fetchall()) == ""


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_sql_has_a_query():
    from tallyloom.plans.oracles import ORACLES

    assert set(ORACLES) <= set(queries())
