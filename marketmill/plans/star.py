"""Star schema: raw-shaped DataFrames in, dimension and fact DataFrames out.

Raw columns may arrive as strings (CSV landing) or typed; every cast is by name and strict.
Each child table is rolled up to one row per order before it is joined, so a hot order
collapses on the map side and the exchange of the rollup also serves the join.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketmill.functions import from_minor, minor_units, money_sum, month_label
from marketmill.operators.selection import smallest_row


def dim_customers(raw_customers: DataFrame) -> DataFrame:
    """One row per person. The address is that of the smallest customer_id, taken whole."""
    address = ("customer_zip_code_prefix", "customer_city", "customer_state")
    return smallest_row(
        raw_customers, "customer_unique_id", "customer_id", address, "n_customer_ids"
    ).select(
        F.col("customer_unique_id").alias("customer_sk"),
        F.col("customer_zip_code_prefix").alias("zip_code_prefix"),
        F.col("customer_city").alias("city"),
        F.col("customer_state").alias("state"),
        "n_customer_ids",
    )


def dim_products(raw_products: DataFrame, raw_category_translation: DataFrame) -> DataFrame:
    # No broadcast hint: Spark broadcasts the translation only while it is under
    # spark.sql.autoBroadcastJoinThreshold, and falls back to a shuffle join beyond it.
    translation = raw_category_translation.select(
        "product_category_name",
        F.col("product_category_name_english").alias("category_en"),
    )
    return raw_products.join(translation, "product_category_name", "left").select(
        F.col("product_id").alias("product_sk"),
        F.col("product_category_name").alias("category_pt"),
        "category_en",
        F.col("product_name_lenght").cast("int").alias("product_name_length"),
        F.col("product_description_lenght").cast("int").alias("product_description_length"),
        F.col("product_photos_qty").cast("int"),
        F.col("product_weight_g").cast("double"),
        F.col("product_length_cm").cast("double"),
        F.col("product_height_cm").cast("double"),
        F.col("product_width_cm").cast("double"),
    )


def dim_sellers(raw_sellers: DataFrame) -> DataFrame:
    return raw_sellers.select(
        F.col("seller_id").alias("seller_sk"),
        F.col("seller_zip_code_prefix").alias("zip_code_prefix"),
        F.col("seller_city").alias("city"),
        F.col("seller_state").alias("state"),
    )


def dim_date(raw_orders: DataFrame) -> DataFrame:
    """Every calendar day from the first to the last purchase."""
    purchased = F.col("order_purchase_timestamp").cast("timestamp_ntz").cast("date")
    span = raw_orders.agg(F.min(purchased).alias("lo"), F.max(purchased).alias("hi"))
    days = span.select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date_sk")
    )
    return days.select(
        "date_sk",
        F.year("date_sk").alias("year"),
        F.month("date_sk").alias("month"),
        F.dayofmonth("date_sk").alias("day"),
        (F.dayofweek("date_sk") - 1).alias("day_of_week"),  # Sunday is 0
        month_label("date_sk").alias("year_month"),
    )


def fact_order_items(raw_order_items: DataFrame) -> DataFrame:
    return raw_order_items.select(
        "order_id",
        F.col("order_item_id").cast("int"),
        F.col("product_id").alias("product_sk"),
        F.col("seller_id").alias("seller_sk"),
        F.col("shipping_limit_date").cast("timestamp_ntz"),
        F.col("price").cast("double"),
        F.col("freight_value").cast("double"),
    )


def payments_rollup(raw_order_payments: DataFrame) -> DataFrame:
    """Hashed by order and type first: the largest type is a string, which only a sort-based
    aggregate can hold, and there are few types per order left to sort."""
    by_type = raw_order_payments.groupBy("order_id", "payment_type").agg(
        F.sum(minor_units(F.col("payment_value").cast("double"))).alias("minor"),
        F.count("*").alias("lines"),
    )
    return by_type.groupBy("order_id").agg(
        from_minor(F.sum("minor")).alias("payment_value_total"),
        F.sum("lines").alias("n_payment_lines"),
        F.max("payment_type").alias("payment_type_primary"),
    )


def reviews_rollup(raw_order_reviews: DataFrame) -> DataFrame:
    return raw_order_reviews.groupBy("order_id").agg(
        F.avg(F.col("review_score").cast("double")).alias("review_score_avg"),
        F.count("*").alias("n_reviews"),
    )


def items_rollup(fact_order_items: DataFrame) -> DataFrame:
    return fact_order_items.groupBy("order_id").agg(
        money_sum("price").alias("gmv_items"),
        money_sum("freight_value").alias("freight_total"),
        F.count("*").alias("n_items"),
    )


def order_dates(raw_orders: DataFrame) -> DataFrame:
    """Orders with their five timestamps cast and the three-valued on-time flag."""
    stamps = [
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ]
    typed = raw_orders.select(
        "order_id",
        "customer_id",
        "order_status",
        *[F.col(c).cast("timestamp_ntz").alias(c) for c in stamps],
    )
    # SQL comparison is already three-valued: null when either side is missing.
    on_time = F.col("order_delivered_customer_date") <= F.col("order_estimated_delivery_date")
    return typed.withColumn("delivered_on_time", on_time)


def on_time_flag(raw_orders: DataFrame) -> DataFrame:
    return order_dates(raw_orders).select("order_id", "delivered_on_time")


def fact_orders(
    raw_orders: DataFrame,
    raw_customers: DataFrame,
    raw_order_payments: DataFrame,
    raw_order_reviews: DataFrame,
    order_items: DataFrame,
) -> DataFrame:
    """One row per order; counts and money default to zero, review and payment type do not."""
    person = raw_customers.select(
        "customer_id", F.col("customer_unique_id").alias("customer_sk")
    )

    def zero_if_missing(name: str, kind: str):
        return F.coalesce(F.col(name), F.lit(0).cast(kind)).alias(name)

    return (
        order_dates(raw_orders)
        .join(person, "customer_id", "left")
        .join(payments_rollup(raw_order_payments), "order_id", "left")
        .join(reviews_rollup(raw_order_reviews), "order_id", "left")
        .join(items_rollup(order_items), "order_id", "left")
        .select(
            "order_id",
            "customer_sk",
            "order_status",
            "order_purchase_timestamp",
            F.col("order_purchase_timestamp").cast("date").alias("purchase_date_sk"),
            "order_approved_at",
            "order_delivered_carrier_date",
            "order_delivered_customer_date",
            "order_estimated_delivery_date",
            "delivered_on_time",
            zero_if_missing("payment_value_total", "double"),
            zero_if_missing("n_payment_lines", "bigint"),
            "payment_type_primary",
            "review_score_avg",
            zero_if_missing("n_reviews", "bigint"),
            zero_if_missing("gmv_items", "double"),
            zero_if_missing("freight_total", "double"),
            zero_if_missing("n_items", "bigint"),
        )
    )


def _orders_from(raw: Mapping[str, DataFrame], order_items: DataFrame) -> DataFrame:
    return fact_orders(
        raw["raw_orders"],
        raw["raw_customers"],
        raw["raw_order_payments"],
        raw["raw_order_reviews"],
        order_items,
    )


# How each star table comes from the raw tables.
BUILDERS: dict[str, Callable[[Mapping[str, DataFrame]], DataFrame]] = {
    "dim_customers": lambda raw: dim_customers(raw["raw_customers"]),
    "dim_products": lambda raw: dim_products(
        raw["raw_products"], raw["raw_category_translation"]
    ),
    "dim_sellers": lambda raw: dim_sellers(raw["raw_sellers"]),
    "dim_date": lambda raw: dim_date(raw["raw_orders"]),
    "fact_order_items": lambda raw: fact_order_items(raw["raw_order_items"]),
    "fact_orders": lambda raw: _orders_from(raw, fact_order_items(raw["raw_order_items"])),
}


def build_star(
    raw: Mapping[str, DataFrame], order_items: DataFrame | None = None
) -> dict[str, DataFrame]:
    """All six tables as lazy DataFrames; lines that are already written may be given."""
    tables = {name: build(raw) for name, build in BUILDERS.items()}
    if order_items is not None:
        tables["fact_order_items"] = order_items
        tables["fact_orders"] = _orders_from(raw, order_items)
    return tables
