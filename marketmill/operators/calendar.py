"""Month series and the gaps in it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketmill.functions import month_start


def monthly_counts(df: DataFrame, stamp: str) -> DataFrame:
    """Rows per calendar month: (month date, orders, first, last)."""
    return df.groupBy(month_start(stamp).alias("month")).agg(
        F.count("*").alias("orders"),
        F.min(stamp).alias("first"),
        F.max(stamp).alias("last"),
    )


def missing_months(months: DataFrame) -> DataFrame:
    """Months of the spine first..last that have no row."""
    spine = months.agg(F.min("month").alias("lo"), F.max("month").alias("hi")).select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("month")
    )
    return spine.join(months.select("month"), "month", "left_anti")
