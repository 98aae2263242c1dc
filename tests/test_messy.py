"""Every query against its SQL on random messy raw tables, and on empty ones."""

import duckdb
import pytest

import __spark_entry__ as registry
from marketmill.contracts import RAW_COLUMNS
from marketmill.marts import QUERIES, Limits, Marts
from tests import messy
from tests.test_oracle import RAW_SHAPE, oracle_on_raw
from tools.compare import differences

LIMITS = Limits(3, 1, 1995, 2001, 600.0, "NATION_7")


def frames(spark, rows):
    return {
        table: spark.createDataFrame(
            rows.get(table, []), ", ".join(f"{c} {t}" for c, t in columns.items())
        )
        for table, columns in RAW_COLUMNS.items()
    }


@pytest.fixture(scope="module", params=[1, 2])
def both_sides(request, spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("messy"))
    con, raw = duckdb.connect(), {}
    for table, df in frames(spark, messy.tables(request.param)).items():
        path = f"{root}/{table}"
        df.repartition(3).write.parquet(path)
        raw[table] = spark.read.parquet(path)
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}/*.parquet')")
    marts = Marts(spark, raw, LIMITS)
    for name in ("fact_orders", "dim_customers", "dim_products", "product_totals"):
        path = f"{root}/{name}"
        marts.table(name).write.parquet(path)
        marts._tables[name] = spark.read.parquet(path)
    return marts, con


@pytest.mark.parametrize("name", sorted(set(QUERIES) - RAW_SHAPE))
def test_matches_sql(both_sides, name):
    marts, con = both_sides
    problems, _ = differences(QUERIES[name](marts), con.sql(oracle_on_raw(name)))
    assert problems == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_runs_on_empty_tables(spark, name):
    df = QUERIES[name](Marts(spark, frames(spark, {})))
    df.collect()
    assert df.columns == registry.queries()[name](spark, "/root/testdata/sf0.001").columns
