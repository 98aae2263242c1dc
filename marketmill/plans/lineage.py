"""The freshness stamp of a star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def source_freshness(fact_orders: DataFrame) -> DataFrame:
    return fact_orders.agg(
        F.min("order_purchase_timestamp").alias("min_order_purchase_timestamp"),
        F.max("order_purchase_timestamp").alias("max_order_purchase_timestamp"),
        F.count("*").alias("n_orders"),
    )
