"""Every registered query against its SQL, on the test tables and on the hand-made extract."""

import duckdb
import pytest

import __spark_entry__ as registry
from marketmill.contracts import RAW_COLUMNS, RAW_FILE_BY_TABLE
from marketmill.marts import QUERIES
from oracles.base import RAW
from tests import raw_fixture
from tests.conftest import SMALL
from tools.compare import connect, differences

ORACLES = registry.oracle_sql()

# The shape of the raw tables themselves: types and extra columns differ on the CSV path.
RAW_SHAPE = {"manifest_check", "table_profile"}

DUCK_TYPES = {"string": "VARCHAR", "int": "INTEGER", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def small_con():
    return connect(SMALL)


@pytest.fixture(scope="module")
def fixture_con(raw_folder):
    con = duckdb.connect()
    for table, columns in RAW_COLUMNS.items():
        path = f"{raw_folder}/{RAW_FILE_BY_TABLE[table].file_name(raw_fixture.PREFIX)}"
        picked = ", ".join(f"CAST({c} AS {DUCK_TYPES[t]}) AS {c}" for c, t in columns.items())
        con.execute(
            f"CREATE VIEW {table} AS SELECT {picked} "
            f"FROM read_csv('{path}', header=true, all_varchar=true)"
        )
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLES) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql_on_test_tables(spark, small_con, name):
    df = registry.queries()[name](spark, SMALL)
    problems, _ = differences(df, small_con.sql(ORACLES[name]))
    assert problems == []


def oracle_on_raw(name):
    """The SQL of a query over raw tables that are already there, with small thresholds."""
    sql = ORACLES[name].replace(RAW.strip() + ",", "", 1)
    assert "lineitem" not in sql
    for limit, small in (
        (">= 150", ">= 1"),
        ("orders < 100", "orders < 3"),
        ("orders >= 100", "orders >= 3"),
        ("400000.0", "600.0"),
    ):
        sql = sql.replace(limit, small)
    return sql


@pytest.mark.parametrize("name", sorted(set(QUERIES) - RAW_SHAPE))
def test_matches_sql_on_hand_made_extract(fixture_marts, fixture_con, name):
    problems, _ = differences(QUERIES[name](fixture_marts), fixture_con.sql(oracle_on_raw(name)))
    assert problems == []


def test_entry_runs(spark):
    assert registry.entry(spark).count() == 1
