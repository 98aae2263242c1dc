"""Hot keys, lineage and settings: what must hold when the tables are large."""

import uuid

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from marketmill.functions import money_sum, stable_average
from marketmill.marts import SETTLED, Marts
from marketmill.plans import insights, kpis, star
from marketmill.session import PLAN_SETTINGS, shuffle_partitions
from marketmill.sources.snapshot import Snapshot, shared_folder
from marketmill.sources.standin import StandinRaw
from tests.conftest import SMALL


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    before = {}

    def change(**settings):
        for key, value in settings.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture
def splitting(conf):
    """Thresholds small enough for a test table to count as large and skewed."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__shuffle__partitions="16",
    )


def hot(spark, rows, share=3):
    """Order ids where every third row belongs to order 0."""
    i = F.col("id")
    return spark.range(rows).withColumn(
        "order_id", F.when(i % share == 0, F.lit(0)).otherwise(i % 5000)
    )


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_hot_order_is_split_between_tasks(spark, splitting):
    lines = hot(spark, 300_000).select(
        "order_id",
        (F.col("id") % 97).alias("product_sk"),
        F.round(F.rand(7), 2).alias("price"),
        F.round(F.rand(8), 2).alias("freight_value"),
    )
    orders = spark.range(5000).select(
        F.col("id").alias("order_id"), F.lit("delivered").alias("order_status")
    )
    totals = kpis.product_totals(lines, orders)
    assert "skew=true" in final_plan(totals)
    assert totals.agg(F.sum("n_lines")).first()[0] == 300_000


def test_hot_review_order_is_split(spark, splitting):
    reviews = hot(spark, 300_000).select(
        "order_id",
        (1 + F.col("id") % 5).cast("int").alias("review_score"),
        F.expr("timestamp_ntz'2018-01-01 00:00:00' + make_dt_interval(int(hash(id) % 300))").alias(
            "review_creation_date"
        ),
    )
    stamp = F.expr("timestamp_ntz'2018-01-01 00:00:00'")
    orders = spark.range(5000).select(
        F.col("id").alias("order_id"),
        F.lit("delivered").alias("order_status"),
        stamp.alias("order_purchase_timestamp"),
        stamp.alias("order_estimated_delivery_date"),
        stamp.alias("order_delivered_customer_date"),
    )
    timing = insights.review_timing(orders, reviews)
    assert "skew=true" in final_plan(timing)
    assert timing.first().orders == 300_000


def test_orders_without_customer_are_split(spark, splitting):
    """A third of all orders without a customer share the null key of the outer join."""
    stamp = F.expr("timestamp_ntz'2018-01-01 00:00:00'")
    orders = spark.range(300_000).select(
        F.concat(F.lit("order-"), F.hash("id")).alias("order_id"),
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        *[
            stamp.alias(c)
            for c in (
                "order_purchase_timestamp",
                "order_approved_at",
                "order_delivered_carrier_date",
                "order_delivered_customer_date",
                "order_estimated_delivery_date",
            )
        ],
    )
    customers = spark.range(300_000).select(
        F.col("id").alias("customer_id"), (F.col("id") % 999).alias("customer_unique_id")
    )
    nothing = {
        "pay": "order_id string, payment_type string, payment_value double",
        "rev": "order_id string, review_score int",
        "item": "order_id string, price double, freight_value double",
    }
    pay, rev, item = (spark.createDataFrame([], ddl) for ddl in nothing.values())
    built = star.fact_orders(orders, customers, pay, rev, item)
    assert "skew=true" in final_plan(built)
    found = built.agg(F.count("*").alias("n"), F.count("customer_sk").alias("known")).first()
    assert (found.n, found.known) == (300_000, 200_000)


def test_hot_person_collapses_before_the_shuffle(spark, splitting):
    orders = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500).alias("customer_sk")
    )
    people = spark.range(500).select(
        F.col("id").alias("customer_sk"), F.concat(F.lit("S"), F.col("id") % 7).alias("state")
    )
    totals = kpis.state_totals(orders, people)
    plan = final_plan(totals)
    assert plan.index("SortMergeJoin") < plan.index("partial_count")
    assert totals.agg(F.sum("orders")).first()[0] == 300_000


class FakeSession:
    """A session with its own start-up settings, which a running one cannot change."""

    def __init__(self, spark, **settings):
        self.read = spark.read
        self.conf = self
        self._settings = settings

    def get(self, key, default=None):
        return self._settings.get(key.replace(".", "_"), default)


def test_snapshot_goes_to_the_folder_the_session_names(spark, tmp_path):
    named = FakeSession(spark, spark_checkpoint_dir=f"{tmp_path}/shared/", spark_master="yarn")
    assert shared_folder(named) == f"{tmp_path}/shared"
    first, second = Snapshot(named, "t"), Snapshot(named, "t")
    assert first.root != second.root
    kept = first.settle("numbers", spark.range(10))
    assert all(first.root in f for f in kept.inputFiles())
    assert kept.count() == 10


def test_cluster_without_shared_folder_is_an_error(spark):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        Snapshot(FakeSession(spark, spark_master="yarn"), "t")


def test_snapshot_is_removed_at_close(spark, tmp_path):
    named = FakeSession(spark, spark_checkpoint_dir=str(tmp_path), spark_master="yarn")
    snapshot = Snapshot(named, "t")
    snapshot.settle("numbers", spark.range(10))
    assert len(list(tmp_path.iterdir())) == 1
    snapshot._spark = spark
    snapshot.close()
    assert list(tmp_path.iterdir()) == []


def test_averages_of_thirds_do_not_depend_on_partitioning(spark):
    rows = [(i, (i % 15) / 3, i % 4 == 0) for i in range(5000)]
    df = spark.createDataFrame(rows, "i long, review_score_avg double, late boolean")
    found = {
        df.repartition(n, "i").agg(stable_average("review_score_avg")).first()[0]
        for n in (1, 2, 3, 5, 7, 16)
    }
    assert len(found) == 1 and abs(found.pop() - sum(r[1] for r in rows) / 5000) < 1e-11


def test_money_finer_than_four_decimals_is_refused(spark):
    fine = spark.createDataFrame([(0.0001,), (33.33,), (None,), (-7.1234,)], "m double")
    assert fine.agg(money_sum("m")).first()[0] == 26.2067
    with pytest.raises(Exception, match="finer than four decimals"):
        spark.createDataFrame([(0.00004,)] * 9, "m double").agg(money_sum("m")).collect()


def test_local_session_may_use_a_temporary_folder(spark):
    assert shared_folder(FakeSession(spark, spark_master="local[2]")).startswith("/")


def test_settled_tables_equal_lazy_ones(spark):
    lazy = Marts(spark, StandinRaw(spark, SMALL))
    kept = registry.marts_for(spark, SMALL)
    for name in SETTLED:
        a, b = lazy.table(name), kept.table(name)
        assert a.schema == b.schema or a.dtypes == b.dtypes
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_settled_once_per_folder(spark):
    marts = registry.marts_for(spark, SMALL)
    assert registry.marts_for(spark, SMALL) is marts
    assert marts.table("fact_orders") is marts.table("fact_orders")


def test_sums_do_not_depend_on_task_order(spark):
    marts = registry.marts_for(spark, SMALL)
    shuffled = marts.fact_orders.repartition(7, F.lit(str(uuid.uuid4())), "customer_sk")
    assert kpis.kpi_summary(shuffled).collect() == kpis.kpi_summary(marts.fact_orders).collect()


def test_shuffle_partitions():
    assert shuffle_partitions(100 * 2**40, 4000) == 819_200
    assert shuffle_partitions(1, 64) == 64
    assert PLAN_SETTINGS["spark.sql.adaptive.skewJoin.enabled"] == "true"
