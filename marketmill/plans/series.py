"""Series behind the charts. Drawing is left to the reader's own tool."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketmill.functions import (
    bucket_order,
    day_gap,
    from_minor,
    lateness_bucket,
    percent,
    round_half,
    stable_average,
)
from marketmill.operators.histogram import equal_width_histogram
from marketmill.operators.selection import median_of
from marketmill.plans.insights import (
    STATE_MIN_ORDERS,
    THIN_MONTH_MIN,
    coverage_monthly,
    delivery_by_state,
    identity_summary,
    mean_of_values,
    reviewed_deliveries,
    with_lateness,
)
from marketmill.plans.kpis import person_totals, with_status

# Chart labels and the axis clip of the order value chart.
CHART_LABELS = ("on time\nor early", "1-7 days\nlate", "8-30 days\nlate", "over 30\ndays late")
ORDER_VALUE_CLIP = 600.0
ORDER_VALUE_BINS = 60


def fig_coverage_series(fact_orders: DataFrame, minimum: int = THIN_MONTH_MIN) -> DataFrame:
    return coverage_monthly(fact_orders).withColumn("thin", F.col("orders") < minimum)


def fig_customer_key(
    fact_orders: DataFrame, dim_customers: DataFrame, raw_orders: DataFrame
) -> DataFrame:
    """Repeat rate keyed on the person against keyed on the per-order id, by one rule."""

    def repeat_pct(counts: DataFrame):
        return counts.agg(
            percent(F.count_if(F.col("orders") > 1), F.count("*"))
        ).scalar()

    by_person = person_totals(with_status(fact_orders))
    by_order_id = with_status(raw_orders).groupBy("customer_id").agg(
        F.count("*").alias("orders")
    )
    return identity_summary(dim_customers).select(
        "*",
        repeat_pct(by_person).alias("repeat_pct_by_person"),
        repeat_pct(by_order_id).alias("repeat_pct_by_order_id"),
    )


def fig_customer_ids(dim_customers: DataFrame) -> DataFrame:
    return (
        dim_customers.where(F.col("n_customer_ids") > 1)
        .groupBy(F.col("n_customer_ids").alias("ids"))
        .agg(F.count("*").alias("people"))
        .orderBy("ids")
    )


def fig_lateness_series(fact_orders: DataFrame) -> DataFrame:
    low = F.count_if(F.col("review_score_avg") <= 2)
    return (
        with_lateness(fact_orders)
        .groupBy(
            bucket_order("late_days").alias("bucket_order"),
            lateness_bucket("late_days", CHART_LABELS).alias("bucket"),
        )
        .agg(
            F.count("*").alias("orders"),
            round_half(stable_average("review_score_avg"), 2).alias("avg_review"),
            percent(low, F.count("review_score_avg"), 1).alias("pct_one_or_two_star"),
        )
        .orderBy("bucket_order")
    )


def fig_review_waits(fact_orders: DataFrame, raw_order_reviews: DataFrame) -> DataFrame:
    return (
        reviewed_deliveries(fact_orders, raw_order_reviews)
        .groupBy(
            bucket_order("late_days").alias("bucket_order"),
            lateness_bucket("late_days", CHART_LABELS).alias("bucket"),
        )
        .agg(
            round_half(F.avg(day_gap("purchased_on", "reviewed_on")), 1).alias("days_waited_at_review"),
            round_half(F.avg(day_gap("purchased_on", "delivered_on")), 1).alias("days_waited_in_total"),
        )
        .orderBy("bucket_order")
    )


def fig_state_bubbles(
    fact_orders: DataFrame,
    dim_customers: DataFrame,
    min_orders: int = STATE_MIN_ORDERS,
    highlight: str = "RJ",
) -> DataFrame:
    return delivery_by_state(fact_orders, dim_customers, min_orders).select(
        "state",
        "orders",
        F.col("avg_days_to_deliver").alias("days"),
        F.col("pct_late").alias("late_pct"),
        F.col("avg_review").alias("review"),
        # Powers differ in the last bit between maths libraries; a marker size needs no more.
        round_half(F.lit(40.0) + F.pow("orders", F.lit(0.62)), 6).alias("bubble_size"),
        (F.col("state") == highlight).alias("highlighted"),
    )


def fig_order_value_hist(
    values: DataFrame, clip: float = ORDER_VALUE_CLIP, bins: int = ORDER_VALUE_BINS
) -> DataFrame:
    """Orders above zero and up to the clip, in equal bins over the range they cover; from
    ``order_values``."""
    value = F.col("gmv_items")
    shown = values.select(from_minor("v").alias("gmv_items"), "n").where((value > 0) & (value <= clip))
    return equal_width_histogram(shown, "gmv_items", bins, "n").withColumnRenamed("n", "orders")


def fig_order_value_lines(values: DataFrame) -> DataFrame:
    """The two marker lines: mean and median over all delivered orders, unrounded; from
    ``order_values``."""
    return values.agg(mean_of_values().alias("mean_order_gmv")).select(
        "mean_order_gmv", median_of(values).scalar().alias("median_order_gmv")
    )
