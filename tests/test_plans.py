"""What the physical plans may and may not hold, with broadcasting by size switched off so
that they look as they would on large tables."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from marketmill import marts
from marketmill.marts import QUERIES
from marketmill.plans import kpis, quality
from marketmill.sinks.star_files import save_bucketed
from marketmill.sources.snapshot import Snapshot
from marketmill.sources.standin import StandinRaw
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield spark
    spark.conf.set(key, before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python(no_broadcast, name):
    plan = plan_of(registry.queries()[name](no_broadcast, SMALL))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
        assert banned not in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_nothing_is_broadcast_by_hint(no_broadcast, name):
    assert "BroadcastExchange" not in plan_of(registry.queries()[name](no_broadcast, SMALL))


def test_filter_and_columns_reach_the_scan(spark):
    plan = plan_of(registry.queries()["kpi_repeat_customers"](spark, SMALL))
    assert "EqualTo(order_status,delivered)" in plan
    assert "ReadSchema: struct<customer_sk:bigint,order_status:string>" in plan


def test_unused_rollups_are_dropped(spark):
    marts = registry.marts_for(spark, SMALL)
    months = marts.plan("fact_orders").groupBy("purchase_date_sk").agg(F.count("*").alias("n"))
    assert "events" not in plan_of(months)


def test_fact_orders_joins_without_moving_rows_again(no_broadcast):
    """One exchange per input: the chained joins on the order key reuse its partitioning."""
    plan = plan_of(registry.queries()["fact_orders"](no_broadcast, SMALL))
    top = plan.split("FileScan")[0]
    assert "Exchange" not in top.split("SortMergeJoin [o_orderkey")[0]


def test_the_audit_reads_each_table_once_and_moves_keys_once(no_broadcast, fixture_run):
    tables = fixture_run[1].tables
    rules = quality.standard_rules() + quality.relation_rules()
    plan = plan_of(quality.run_rules(tables, rules))
    assert plan.count("FileScan") == len(tables) == 6
    assert len(re.findall(r"Exchange hashpartitioning\(relation", plan)) == 1
    assert plan.count("Exchange") == 2  # the other one is of one row per task
    assert "SortAggregate" not in plan and "Join" not in plan


def test_the_gate_reads_lines_and_orders_twice_at_most(no_broadcast):
    plan = plan_of(registry.queries()["dq_gate"](no_broadcast, SMALL))
    scans = re.findall(r"FileScan.*?Location: [^]]*?([a-z_]+(?:\.parquet)?)]", plan)
    assert scans and max(scans.count(name) for name in set(scans)) <= 2
    assert plan.count("FileScan") <= 7


def test_the_address_of_a_person_is_picked_without_sorting(no_broadcast):
    assert "SortAggregate" not in plan_of(registry.queries()["dim_customers"](no_broadcast, SMALL))


@pytest.mark.parametrize("name", ["order_value", "fig_order_value_hist", "fig_order_value_lines"])
def test_order_values_come_from_one_table(no_broadcast, name):
    df = registry.queries()[name](no_broadcast, SMALL)
    assert {file.split("/")[-2] for file in df.inputFiles()} == {"order_values"}
    read = set(re.findall(r"ReadSchema: struct<([^>]*)>", plan_of(df)))
    assert "v:bigint,n:bigint" in read and read <= {"v:bigint,n:bigint", "v:bigint"}


def test_people_meet_their_state_on_one_partitioning(no_broadcast):
    plan = plan_of(registry.queries()["kpi_gmv_by_state"](no_broadcast, SMALL))
    assert len(re.findall(r"Exchange hashpartitioning\(customer_sk", plan)) == 2
    assert "partial_count" in plan


def test_bucketed_tables_join_without_exchange(no_broadcast, fixture_run, tmp_path):
    tables = save_bucketed(fixture_run[1].tables, str(tmp_path), 4, "bucketed_")
    lines = kpis.order_lines(tables["fact_order_items"], tables["fact_orders"], None)
    assert "Exchange" not in plan_of(lines)
    assert lines.count() == 10
    people = kpis.person_totals(tables["fact_orders"])
    assert people.count() == 9
    for name in tables:
        no_broadcast.sql(f"drop table bucketed_{name}")


def test_coverage_waits_for_no_written_orders(spark):
    """On fresh input the coverage queries read neither lines nor reviews, and write no table; they
    read the kept orders once these are there, and give the same."""
    fresh = marts.Marts(spark, StandinRaw(spark, SMALL), registry.TEST_LIMITS, Snapshot(spark, "test"))
    names = [n for n in marts.QUERIES if n.startswith("coverage_")] + ["fig_coverage_series"]
    assert len(names) == 6
    planned = {n: marts.QUERIES[n](fresh) for n in names}
    assert "fact_orders" not in fresh._tables
    for frame in planned.values():
        plan = plan_of(frame)
        assert "lineitem" not in plan and "events" not in plan and "orders" in plan
    before = {n: frame.collect() for n, frame in planned.items()}
    fresh.fact_orders  # built and kept
    for n in names:
        frame = marts.QUERIES[n](fresh)
        assert "marketmill-test-" in plan_of(frame) and frame.collect() == before[n]
    assert before["coverage_monthly"]
