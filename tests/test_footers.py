"""Figures of written tables: the same as from their rows, and taken from the footers."""

import pytest

from marketmill.contracts import RAW_COLUMNS, STAR_COLUMNS
from marketmill.operators.profile import profile_tables, row_counts
from marketmill.plans.lineage import source_freshness
from marketmill.sinks import publish, star_files
from marketmill.sources import footers, raw_files


@pytest.fixture(scope="module")
def root(spark, fixture_run):
    lake, run = fixture_run
    return publish.version_root(lake, run.version)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_written_figures_equal_those_of_the_rows(spark, root, fixture_marts):
    tables = star_files.read_star(spark, root)
    assert rows(footers.written_counts(spark, root, STAR_COLUMNS)) == rows(row_counts(tables))
    fresh = footers.written_freshness(spark, root)
    assert rows(fresh) == rows(source_freshness(tables["fact_orders"]))
    assert fresh.dtypes == source_freshness(tables["fact_orders"]).dtypes
    raw = {t: df for t, df in raw_files.read_landed(spark, f"{root}/raw").items() if t in RAW_COLUMNS}
    profile = footers.written_profile(spark, f"{root}/raw", raw)
    assert rows(profile) == rows(profile_tables(raw)) and profile.dtypes == profile_tables(raw).dtypes
    assert rows(fixture_marts.row_counts()) == rows(row_counts(tables))
    assert rows(fixture_marts.freshness()) == rows(fresh)
    assert rows(fixture_marts.profile()) == rows(profile)


def test_figures_come_from_footers(spark, root):
    tables = footers.footer_tables(spark, root, STAR_COLUMNS)
    for name, df in tables.items():
        plan = plan_of(row_counts({name: df}))
        assert "PushedAggregation: [COUNT(*)]" in plan and "BatchScan" in plan
        assert "PushedAggregation: [COUNT(" in plan_of(profile_tables({name: df}))
    plan = plan_of(footers.day_bounds(tables["fact_orders"]))
    assert "MIN(purchase_date_sk), MAX(purchase_date_sk), COUNT(*)" in plan


def test_moments_come_from_the_rows_of_two_days(spark, root):
    plan = plan_of(footers.written_freshness(spark, root))
    assert "PushedFilters: [In(purchase_date_sk" in plan.replace("Or(EqualTo(purchase_date_sk", "In(purchase_date_sk")


def test_the_callers_session_keeps_its_settings(spark, root):
    footers.written_counts(spark, root, STAR_COLUMNS)
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_an_empty_written_star(spark, tmp_path):
    for name in STAR_COLUMNS:
        star_files.write_table(spark.createDataFrame([], star_files.star_schema(name)), str(tmp_path), name)
    assert {r.n for r in footers.written_counts(spark, str(tmp_path), STAR_COLUMNS).collect()} == {0}
    assert rows(footers.written_freshness(spark, str(tmp_path))) == [(None, None, 0)]
