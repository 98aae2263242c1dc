"""Insight tables: coverage, integrity, identity, repeat buying, delivery, concentration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketmill.functions import (
    BUCKET_LABELS,
    average_of_sums,
    day_gap,
    from_minor,
    lateness_bucket,
    minor_units,
    month_label,
    percent,
    quotient_sums,
    round_half,
    stable_average,
)
from marketmill.operators.calendar import missing_months, monthly_counts
from marketmill.operators.selection import median_of, top_with_total, value_counts
from marketmill.plans.kpis import (
    category_totals,
    person_totals,
    state_totals,
    with_status,
)

# Published thresholds, all overridable per call.
THIN_MONTH_MIN = 1000
STATE_MIN_ORDERS = 500
LOW_REVIEW = 2

PURCHASED = "order_purchase_timestamp"
DELIVERY = "order_delivered_customer_date"
PROMISED = "order_estimated_delivery_date"


def _late() -> Column:
    """Late by the timestamp flag; rows without a flag are not counted."""
    return F.count_if(~F.col("delivered_on_time"))


def _low_review() -> Column:
    return F.count_if(F.col("review_score_avg") <= LOW_REVIEW)


def delivered_with_date(fact_orders: DataFrame) -> DataFrame:
    return with_status(fact_orders).where(F.col(DELIVERY).isNotNull())


def with_lateness(fact_orders: DataFrame) -> DataFrame:
    """Delivered orders with the calendar-day lateness against the promise."""
    return delivered_with_date(fact_orders).withColumn("late_days", day_gap(PROMISED, DELIVERY))


# --- coverage -------------------------------------------------------------------------


def order_months(fact_orders: DataFrame) -> DataFrame:
    return monthly_counts(fact_orders, PURCHASED)


def coverage_bounds(fact_orders: DataFrame) -> DataFrame:
    return order_months(fact_orders).agg(
        F.min("first").alias("first_order"),
        F.max("last").alias("last_order"),
        F.count("*").alias("months_observed"),
    )


def coverage_monthly(fact_orders: DataFrame) -> DataFrame:
    return (
        order_months(fact_orders)
        .orderBy(F.asc_nulls_last("month"))
        .select(month_label("month").alias("year_month"), "orders")
    )


def coverage_missing_months(fact_orders: DataFrame) -> DataFrame:
    return missing_months(order_months(fact_orders)).select(
        month_label("month").alias("year_month")
    )


def coverage_thin_months(fact_orders: DataFrame, minimum: int = THIN_MONTH_MIN) -> DataFrame:
    return coverage_monthly(fact_orders).where(F.col("orders") < minimum)


def coverage_reliable_window(
    fact_orders: DataFrame, minimum: int = THIN_MONTH_MIN
) -> DataFrame:
    """First and last full month. A thin month in between does not break the window."""
    full = order_months(fact_orders).where(F.col("orders") >= minimum)
    return full.agg(
        month_label(F.min("month")).alias("window_start"),
        month_label(F.max("month")).alias("window_end"),
    )


# --- integrity ------------------------------------------------------------------------


def integrity_counts(fact_orders: DataFrame) -> DataFrame:
    delivered = F.col("order_status") == "delivered"
    return fact_orders.agg(
        F.count("*").alias("orders_total"),
        F.count_if(delivered & F.col(DELIVERY).isNull()).alias(
            "delivered_without_delivery_date"
        ),
        F.count_if(F.coalesce("n_reviews", F.lit(0)) == 0).alias("orders_without_review"),
    )


def integrity_status_contradictions(fact_orders: DataFrame) -> DataFrame:
    return (
        fact_orders.where((F.col("order_status") != "delivered") & F.col(DELIVERY).isNotNull())
        .groupBy("order_status")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "order_status")
    )


# --- customer identity ----------------------------------------------------------------


def identity_distribution(dim_customers: DataFrame) -> DataFrame:
    return (
        dim_customers.groupBy(F.col("n_customer_ids").alias("ids_per_person"))
        .agg(F.count("*").alias("people"))
        .orderBy(F.desc("ids_per_person"))
    )


def identity_summary(dim_customers: DataFrame) -> DataFrame:
    return dim_customers.agg(
        F.count("*").alias("people"),
        F.count_if(F.col("n_customer_ids") > 1).alias("people_with_multiple_order_ids"),
        F.max("n_customer_ids").alias("max_order_ids_for_one_person"),
    )


# --- repeat buying --------------------------------------------------------------------


def repeat_segments(fact_orders: DataFrame) -> DataFrame:
    persons = person_totals(
        with_status(fact_orders), F.sum(minor_units("gmv_items")).alias("gmv")
    )
    segment = F.when(F.col("orders") == 1, "one_time").otherwise("repeat")
    return (
        persons.groupBy(segment.alias("segment"))
        .agg(
            F.count("*").alias("customers"),
            round_half(F.try_divide(from_minor(F.sum("gmv")), F.count("gmv")), 2).alias(
                "avg_lifetime_gmv"
            ),
            round_half(stable_average(from_minor("gmv") / F.col("orders"), 20), 2).alias("avg_per_order"),
        )
        .orderBy("segment")
    )


def repeat_rate(fact_orders: DataFrame) -> DataFrame:
    """Null when there is no repeat segment at all, like a share of nothing."""
    counted = person_totals(with_status(fact_orders)).agg(
        F.count("*").alias("customers"),
        F.count_if(F.col("orders") > 1).alias("repeat_customers"),
    )
    rate = F.try_divide(
        F.nullif("repeat_customers", F.lit(0)).cast("double"), F.col("customers")
    )
    return counted.select("customers", "repeat_customers", round_half(rate, 4).alias("repeat_rate"))


# --- delivery and reviews -------------------------------------------------------------


def delivery_national(fact_orders: DataFrame) -> DataFrame:
    return delivered_with_date(fact_orders).agg(
        round_half(F.avg(day_gap(PURCHASED, DELIVERY)), 1).alias("avg_days_to_deliver"),
        percent(_late(), F.count("*"), 1).alias("pct_late"),
    )


def on_time_vs_late(fact_orders: DataFrame) -> DataFrame:
    rated = with_status(fact_orders).where(
        F.col("delivered_on_time").isNotNull() & F.col("review_score_avg").isNotNull()
    )
    return (
        rated.groupBy("delivered_on_time")
        .agg(
            F.count("*").alias("orders"),
            round_half(stable_average("review_score_avg"), 2).alias("avg_review"),
            percent(_low_review(), F.count("*"), 1).alias("pct_one_or_two_star"),
        )
        .orderBy("delivered_on_time")
    )


def lateness_buckets(fact_orders: DataFrame) -> DataFrame:
    return (
        with_lateness(fact_orders)
        .groupBy(lateness_bucket("late_days").alias("bucket"))
        .agg(
            F.count("*").alias("orders"),
            F.count_if(F.col("review_score_avg").isNull()).alias("without_review"),
            round_half(stable_average("review_score_avg"), 2).alias("avg_review"),
            percent(_low_review(), F.count("review_score_avg"), 1).alias(
                "pct_one_or_two_star"
            ),
        )
        .orderBy("bucket")
    )


def delivery_state_totals(fact_orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    return state_totals(
        delivered_with_date(fact_orders),
        dim_customers,
        F.sum(day_gap(PURCHASED, DELIVERY)).alias("days"),
        F.count(day_gap(PURCHASED, DELIVERY)).alias("days_n"),
        _late().alias("late"),
        *quotient_sums("review_score_avg", "review"),
        F.count("review_score_avg").alias("review_n"),
        F.sum(minor_units("freight_total")).alias("freight"),
        F.sum(minor_units("gmv_items")).alias("gmv"),
    )


def delivery_by_state(
    fact_orders: DataFrame, dim_customers: DataFrame, min_orders: int = STATE_MIN_ORDERS
) -> DataFrame:
    return (
        delivery_state_totals(fact_orders, dim_customers)
        .where(F.col("orders") >= min_orders)
        .select(
            "state",
            "orders",
            round_half(F.try_divide("days", "days_n"), 1).alias("avg_days_to_deliver"),
            percent(F.col("late"), F.col("orders"), 1).alias("pct_late"),
            round_half(average_of_sums("review", "review_n"), 2).alias("avg_review"),
            percent(F.col("freight"), F.col("gmv"), 1).alias("freight_pct_of_gmv"),
        )
        .orderBy("avg_days_to_deliver", "state")
    )


# --- review timing --------------------------------------------------------------------


def reviewed_deliveries(fact_orders: DataFrame, raw_order_reviews: DataFrame) -> DataFrame:
    """One row per review of a delivered order, with the order's dates.

    Narrow columns cross the shuffle; a hot order on the review side is split by adaptive
    skew-join handling, as the join is inner and directly over both exchanges. Reviews come
    first: a sort-merge join streams its left side and buffers the matches on its right.
    """
    reviews = raw_order_reviews.select(
        "order_id",
        F.col("review_score").cast("int").alias("review_score"),
        F.col("review_creation_date").cast("timestamp_ntz").cast("date").alias("reviewed_on"),
    )
    orders = with_lateness(fact_orders).select(
        "order_id",
        "late_days",
        F.col(PURCHASED).cast("date").alias("purchased_on"),
        F.col(PROMISED).cast("date").alias("promised_on"),
        F.col(DELIVERY).cast("date").alias("delivered_on"),
    )
    return reviews.join(orders, "order_id")


def review_timing(fact_orders: DataFrame, raw_order_reviews: DataFrame) -> DataFrame:
    """``orders`` counts reviews: the grain of this table is the review."""
    return (
        reviewed_deliveries(fact_orders, raw_order_reviews)
        .groupBy(lateness_bucket("late_days").alias("bucket"))
        .agg(
            F.count("*").alias("orders"),
            round_half(F.avg(day_gap("promised_on", "reviewed_on")), 1).alias("avg_days_survey_after_promise"),
            round_half(F.avg(day_gap("purchased_on", "reviewed_on")), 1).alias("avg_days_waited_when_rated"),
            percent(
                F.count_if(F.col("delivered_on") > F.col("reviewed_on")), F.count("*"), 1
            ).alias("pct_rated_before_delivery"),
            round_half(F.avg("late_days"), 1).alias("avg_final_lateness"),
            round_half(F.avg("review_score"), 2).alias("avg_score"),
        )
        .orderBy("bucket")
    )


# --- concentration --------------------------------------------------------------------


def top_categories(
    per_product: DataFrame, dim_products: DataFrame, top: int = 10
) -> DataFrame:
    """A missing translation is a group of its own, under null."""
    gmv = round_half(from_minor("gmv_minor"), 0)
    return top_with_total(
        category_totals(per_product, dim_products),
        "category",
        [gmv.desc_nulls_last(), F.asc_nulls_last("category")],
        top,
        "gmv_minor",
    ).select(
        "category",
        gmv.alias("gmv"),
        percent(from_minor("gmv_minor"), from_minor("all_gmv_minor"), 2).alias("pct_of_gmv"),
    )


def top10_categories_share(per_product: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Sum of the already rounded shares."""
    return top_categories(per_product, dim_products).agg(
        round_half(F.sum("pct_of_gmv"), 1).alias("top10_categories_share")
    )


def seller_concentration(fact_order_items: DataFrame) -> DataFrame:
    """All statuses. The shares come from a distributed top 100, not from a full ranking."""
    sellers = fact_order_items.groupBy("seller_sk").agg(
        F.sum(minor_units("price")).alias("gmv")
    )
    order = [F.desc_nulls_last("gmv"), F.asc_nulls_last("seller_sk")]
    head = top_with_total(sellers, "seller_sk", order, 100, "gmv")

    def share(k: int) -> Column:
        held = F.sum(F.when(F.col("rank") <= k, F.col("gmv")))
        return percent(from_minor(held), from_minor(F.max("all_gmv")), 1)

    return head.agg(
        F.coalesce(F.max("n_groups"), F.lit(0).cast("bigint")).alias("sellers_total"),
        share(10).alias("top10_sellers_share"),
        share(100).alias("top100_sellers_share"),
    )


def top_states(fact_orders: DataFrame, dim_customers: DataFrame, top: int = 6) -> DataFrame:
    return top_with_total(
        state_totals(with_status(fact_orders), dim_customers),
        "state",
        [F.desc("orders"), F.asc_nulls_last("state")],
        top,
        "orders",
    ).select(
        "state",
        "orders",
        percent(F.col("orders"), F.col("all_orders"), 2).alias("pct_of_orders"),
    )


def top_states_share(fact_orders: DataFrame, dim_customers: DataFrame, top: int = 3) -> DataFrame:
    """What the largest states hold together, summed from their rounded shares."""
    return top_states(fact_orders, dim_customers, top).agg(
        round_half(F.sum("pct_of_orders"), 1).alias(f"top{top}_states_share")
    )


# --- order value ----------------------------------------------------------------------


def order_values(fact_orders: DataFrame) -> DataFrame:
    """The spectrum (v, n) of delivered order values; orders without items count as zero."""
    return value_counts(with_status(fact_orders), "gmv_items")


def mean_of_values() -> Column:
    """The mean of a spectrum, from exact sums."""
    return F.try_divide(from_minor(F.sum(F.col("v") * F.col("n"))), F.sum("n"))


def order_value(values: DataFrame) -> DataFrame:
    """From ``order_values``."""
    median = round_half(median_of(values).scalar(), 2)
    return values.agg(
        round_half(mean_of_values(), 2).alias("mean_order_gmv"),
        round_half(from_minor(F.max("v")), 2).alias("max_order_gmv"),
    ).select(
        "mean_order_gmv",
        median.alias("median_order_gmv"),
        "max_order_gmv",
        round_half(F.try_divide(F.col("mean_order_gmv"), median), 2).alias("mean_over_median"),
    )


def payment_mix(fact_orders: DataFrame) -> DataFrame:
    paid = F.try_divide(
        from_minor(F.sum(minor_units("payment_value_total"))), F.count("payment_value_total")
    )
    return (
        with_status(fact_orders)
        .groupBy(F.col("payment_type_primary").alias("payment_type"))
        .agg(F.count("*").alias("orders"), round_half(paid, 2).alias("avg_payment"))
        .orderBy(F.desc("orders"), F.asc_nulls_last("payment_type"))
    )


# --- figures quoted in the write-up only ----------------------------------------------


def promise_window_by_bucket(fact_orders: DataFrame) -> DataFrame:
    return (
        with_lateness(fact_orders)
        .groupBy(lateness_bucket("late_days").alias("bucket"))
        .agg(
            F.count("*").alias("orders"),
            round_half(F.avg(day_gap(PURCHASED, PROMISED)), 1).alias("avg_promised_days"),
            round_half(F.avg(day_gap(PURCHASED, DELIVERY)), 1).alias("avg_days_to_deliver"),
        )
        .orderBy("bucket")
    )


def state_mix_by_bucket(fact_orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Share of each state inside its lateness bucket.

    The buckets are counted side by side per person, so the one shuffle by person also serves
    the join; the window sees at most one row per state and bucket.
    """
    bucket = lateness_bucket("late_days")
    counts = [
        F.count_if(bucket == label).alias(f"bucket{i}") for i, label in enumerate(BUCKET_LABELS)
    ]
    wide = state_totals(with_lateness(fact_orders), dim_customers, *counts)
    tall = F.array(
        *[
            F.struct(F.lit(label).alias("bucket"), F.col(f"bucket{i}").alias("orders"))
            for i, label in enumerate(BUCKET_LABELS)
        ]
    )
    mix = (
        wide.select("state", F.explode(tall).alias("b"))
        .select("b.bucket", "state", "b.orders")
        .where(F.col("orders") > 0)
    )
    in_bucket = F.sum("orders").over(Window.partitionBy("bucket"))
    return mix.withColumn("pct_of_bucket", percent(F.col("orders"), in_bucket, 1))


def status_share(
    fact_orders: DataFrame, statuses: Sequence[str] = ("canceled", "unavailable")
) -> DataFrame:
    return fact_orders.agg(
        F.count_if(F.col("order_status").isin(*statuses)).alias("orders"),
        F.count("*").alias("orders_total"),
    ).withColumn("pct_of_orders", percent(F.col("orders"), F.col("orders_total"), 1))
