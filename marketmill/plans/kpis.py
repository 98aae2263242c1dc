"""Frozen KPI definitions. Default filter: delivered orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketmill.functions import (
    average_of_sums,
    from_minor,
    minor_units,
    month_label,
    percent,
    quotient_sums,
    round_half,
)
from marketmill.operators.calendar import monthly_counts

DELIVERED = "delivered"
UNKNOWN_CATEGORY = "(unknown)"


def with_status(fact_orders: DataFrame, status: str | None = DELIVERED) -> DataFrame:
    return fact_orders if status is None else fact_orders.where(F.col("order_status") == status)


def order_lines(
    fact_order_items: DataFrame, fact_orders: DataFrame, status: str | None = DELIVERED
) -> DataFrame:
    """Lines of the orders in a status. Both sides shuffle once on order_id; a hot order on
    the line side is split by adaptive skew-join handling."""
    wanted = with_status(fact_orders, status).select("order_id")
    return fact_order_items.join(wanted, "order_id")


def product_totals(fact_order_items: DataFrame, fact_orders: DataFrame) -> DataFrame:
    """Delivered money per product, one row per product, before any dimension is joined.

    Every product and category report starts from it, so the line-to-order join, the widest
    of all, runs once where this table is kept.
    """
    return order_lines(fact_order_items, fact_orders).groupBy("product_sk").agg(
        F.sum(minor_units("price")).alias("gmv_minor"),
        F.sum(minor_units("freight_value")).alias("freight_minor"),
        F.count("*").alias("n_lines"),
    )


def person_totals(fact_orders: DataFrame, *measures: Column) -> DataFrame:
    """Measures per person: a hot person collapses on the map side, and the later join with
    dim_customers is one row to one row on the same partitioning."""
    return fact_orders.groupBy("customer_sk").agg(F.count("*").alias("orders"), *measures)


def state_totals(
    fact_orders: DataFrame, dim_customers: DataFrame, *measures: Column
) -> DataFrame:
    """(state, orders, measure sums) over the persons that have a dimension row."""
    persons = person_totals(fact_orders, *measures)
    names = [c for c in persons.columns if c != "customer_sk"]
    return (
        persons.join(dim_customers.select("customer_sk", "state"), "customer_sk")
        .groupBy("state")
        .agg(*[F.sum(c).alias(c) for c in names])
    )


def kpi_summary(fact_orders: DataFrame) -> DataFrame:
    """The executive row. Grouping by person first gives the distinct count, the repeat rate
    and every sum from one scan and one shuffle."""
    persons = person_totals(
        with_status(fact_orders),
        F.sum(minor_units("gmv_items")).alias("gmv"),
        F.sum(minor_units("freight_total")).alias("freight"),
        F.sum(minor_units("payment_value_total")).alias("payment"),
        F.sum("n_items").alias("items"),
        F.count("n_items").alias("items_n"),
        *quotient_sums("review_score_avg", "review"),
        F.count("review_score_avg").alias("review_n"),
        F.count_if(F.col("delivered_on_time")).alias("on_time"),
        F.count("delivered_on_time").alias("on_time_n"),
    )
    total = persons.agg(
        F.coalesce(F.sum("orders"), F.lit(0).cast("bigint")).alias("orders"),
        F.count("customer_sk").alias("unique_customers"),
        F.count("*").alias("person_groups"),
        F.count_if(F.col("orders") >= 2).alias("repeaters"),
        *[
            F.coalesce(F.sum(c), F.lit(0).cast("bigint")).alias(c)
            for c in ("gmv", "freight", "payment")
        ],
        *[
            F.sum(c).alias(c)
            for c in ("items", "items_n", "review_high", "review_low", "review_n", "on_time", "on_time_n")
        ],
    )
    return total.select(
        F.lit(f"order_status = {DELIVERED}").alias("filter"),
        "orders",
        "unique_customers",
        from_minor("gmv").alias("gmv_items"),
        from_minor("freight").alias("freight_total"),
        from_minor("payment").alias("payment_total"),
        F.try_divide(from_minor("gmv"), F.col("orders")).alias("aov"),
        F.try_divide("items", "items_n").alias("items_per_order"),
        average_of_sums("review", "review_n").alias("avg_review_score"),
        F.try_divide("on_time", "on_time_n").alias("on_time_delivery_rate"),
        F.try_divide("repeaters", "person_groups").alias("repeat_customer_rate"),
    )


def kpi_repeat_customers(fact_orders: DataFrame) -> DataFrame:
    return (
        person_totals(with_status(fact_orders))
        .agg(
            F.count("*").alias("customers"),
            F.count_if(F.col("orders") >= 2).alias("repeat_customers"),
        )
        .withColumn("repeat_customer_rate", F.try_divide("repeat_customers", "customers"))
    )


def kpi_orders_per_month(fact_orders: DataFrame) -> DataFrame:
    dated = with_status(fact_orders).where(F.col("purchase_date_sk").isNotNull())
    return (
        monthly_counts(dated, "purchase_date_sk")
        .select(month_label("month").alias("month"), "orders")
        .orderBy("month")
    )


def category_totals(
    per_product: DataFrame, dim_products: DataFrame, missing: str | None = None
) -> DataFrame:
    """Delivered money per English category, from product_totals.

    With a label for missing ones, lines without a product row or translation are kept under
    it. Without one, lines need a product row, and a missing translation groups under null.
    """
    categories = dim_products.select("product_sk", "category_en")
    category = F.col("category_en")
    if missing is not None:
        category = F.coalesce(category, F.lit(missing))
    return (
        per_product.join(categories, "product_sk", "inner" if missing is None else "left")
        .groupBy(category.alias("category"))
        .agg(
            F.sum("gmv_minor").alias("gmv_minor"),
            F.sum("freight_minor").alias("freight_minor"),
        )
    )


def kpi_gmv_by_category(
    per_product: DataFrame, dim_products: DataFrame, top: int = 12
) -> DataFrame:
    """Products without a row or a translation count as unknown."""
    totals = category_totals(per_product, dim_products, UNKNOWN_CATEGORY)
    return (
        totals.select("category", from_minor("gmv_minor").alias("gmv"))
        .orderBy(F.desc_nulls_last("gmv"), "category")
        .limit(top)
    )


def kpi_status_mix(fact_orders: DataFrame) -> DataFrame:
    return (
        fact_orders.groupBy("order_status")
        .agg(F.count("*").alias("orders"))
        .orderBy(F.desc("orders"), F.asc_nulls_last("order_status"))
    )


def kpi_gmv_by_state(
    fact_orders: DataFrame, dim_customers: DataFrame, top: int = 12
) -> DataFrame:
    gmv = F.sum(minor_units("gmv_items")).alias("gmv")
    return (
        state_totals(with_status(fact_orders), dim_customers, gmv)
        .select("state", from_minor("gmv").alias("gmv"), "orders")
        .orderBy(F.desc_nulls_last("gmv"), F.asc_nulls_last("state"))
        .limit(top)
    )


def preview_state_gmv(
    fact_orders: DataFrame, dim_customers: DataFrame, top: int = 15
) -> DataFrame:
    gmv = F.sum(minor_units("gmv_items")).alias("gmv")
    return (
        state_totals(with_status(fact_orders), dim_customers, gmv)
        .select("state", "orders", round_half(from_minor("gmv"), 2).alias("gmv"))
        .orderBy(F.desc_nulls_last("gmv"), F.asc_nulls_last("state"))
        .limit(top)
    )


def preview_orders(fact_orders: DataFrame, rows: int = 20) -> DataFrame:
    return fact_orders.orderBy(F.asc_nulls_last("order_id")).limit(rows)


def orders_per_customer(fact_orders: DataFrame) -> DataFrame:
    return (
        person_totals(with_status(fact_orders))
        .agg(F.sum("orders").alias("orders"), F.count("customer_sk").alias("unique_customers"))
        .withColumn("orders_per_customer", F.try_divide("orders", "unique_customers"))
    )


def bi_measures(per_product: DataFrame, fact_orders: DataFrame) -> DataFrame:
    """Dashboard measures: money from the line grain, on-time over every status.

    The money is already summed in product_totals, one row per product; what is left is one
    pass over the orders with a distinct count on their key.
    """
    gmv = per_product.agg(from_minor(F.sum("gmv_minor"))).scalar()
    delivered = F.col("order_status") == DELIVERED
    return (
        fact_orders.agg(
            F.count_distinct(F.when(delivered, F.col("order_id"))).alias("orders_delivered"),
            F.count_if(F.col("delivered_on_time")).alias("on_time"),
            F.count("delivered_on_time").alias("on_time_n"),
        )
        .withColumn("gmv_delivered", gmv)
        .select(
            "gmv_delivered",
            "orders_delivered",
            F.try_divide("gmv_delivered", "orders_delivered").alias("aov_delivered"),
            F.try_divide("on_time", "on_time_n").alias("on_time_rate"),
        )
    )


def top_products(per_product: DataFrame, top: int = 10) -> DataFrame:
    return (
        per_product.select("product_sk", from_minor("gmv_minor").alias("gmv"), "n_lines")
        .orderBy(F.desc_nulls_last("gmv"), F.asc_nulls_last("product_sk"))
        .limit(top)
    )


def freight_vs_price(per_product: DataFrame, dim_products: DataFrame) -> DataFrame:
    return category_totals(per_product, dim_products, UNKNOWN_CATEGORY).select(
        "category",
        from_minor("gmv_minor").alias("price_total"),
        from_minor("freight_minor").alias("freight_total"),
        percent(F.col("freight_minor"), F.col("gmv_minor"), 1).alias("freight_pct_of_price"),
    )
