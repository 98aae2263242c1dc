"""Counts and bounds of written Parquet tables, from the statistics in their footers.

Spark answers count, min and max from footers where the Parquet source is the V2 one and its
aggregate push-down is on. Both are settings of a session, so the tables are read in a session of
its own on the same application; the few rows that come out are handed back to the caller's.
Footers hold no usable bounds for timestamps, so the first and the last moment are looked up among
the rows of the first and the last day, which the footers do tell, and whose row groups the scan
then picks by the same statistics.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketmill.operators.profile import profile_tables, row_counts

SETTINGS = {
    "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def footer_tables(
    spark: SparkSession, root: str, names: Iterable[str], schemas: Mapping[str, DataFrame] | None = None
) -> dict[str, DataFrame]:
    """The tables below a root, in a session that reads figures from footers."""
    session = spark.newSession()
    for key, value in SETTINGS.items():
        session.conf.set(key, value)
    found = {}
    for name in names:
        df = session.read.parquet(f"{root}/{name}")
        found[name] = df.select(*schemas[name].columns) if schemas else df
    return found


def _handed_back(spark: SparkSession, figures: DataFrame) -> DataFrame:
    """A few rows (per table, or per column of a table) as a DataFrame of the caller's session.
    A table without any row group has no count in its footers: it is empty."""
    rows = [[0 if v is None else v for v in row] for row in figures.collect()]
    return spark.createDataFrame(rows, figures.schema)


def written_counts(spark: SparkSession, root: str, names: Iterable[str]) -> DataFrame:
    """table_name and n of written tables; no column is read."""
    return _handed_back(spark, row_counts(footer_tables(spark, root, names)))


def written_profile(spark: SparkSession, root: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The profile of written tables with the columns of ``tables``; no column is read."""
    return _handed_back(spark, profile_tables(footer_tables(spark, root, tables, tables)))


def day_bounds(orders: DataFrame) -> DataFrame:
    """First and last purchase day and the number of orders."""
    return orders.agg(
        F.min("purchase_date_sk").alias("first_day"),
        F.max("purchase_date_sk").alias("last_day"),
        F.count("*").alias("n_orders"),
    )


def written_freshness(spark: SparkSession, root: str) -> DataFrame:
    """The freshness stamp of a written star: the day bounds and the count from footers, the two
    moments from the row groups that hold these days."""
    days = day_bounds(footer_tables(spark, root, ["fact_orders"])["fact_orders"]).first()
    day = F.col("purchase_date_sk")
    ends = spark.read.parquet(f"{root}/fact_orders").where(
        day.isin(days["first_day"], days["last_day"]) if days["first_day"] else day.isNotNull()
    )
    return ends.agg(
        F.min("order_purchase_timestamp").alias("min_order_purchase_timestamp"),
        F.max("order_purchase_timestamp").alias("max_order_purchase_timestamp"),
        F.lit(days["n_orders"] or 0).cast("bigint").alias("n_orders"),
    )
