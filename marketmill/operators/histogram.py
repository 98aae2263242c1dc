"""Equal-width histogram over the observed range."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def equal_width_histogram(
    df: DataFrame, value: str, bins: int, weight: str | None = None
) -> DataFrame:
    """(bin, bin_from, bin_to, n) for bins 1..bins, empty ones included; with a weight, a row
    stands for that many.

    The last bin is closed on the right. A single distinct value is put in the middle of a
    range one unit wide. The range is a scalar subquery, so rows are only counted per bin.
    """
    spark = df.sparkSession
    lo, hi = F.min(value), F.max(value)
    span = df.agg(
        F.struct(
            F.when(lo == hi, lo - 0.5).otherwise(lo).alias("lo"),
            F.when(lo == hi, hi + 0.5).otherwise(hi).alias("hi"),
        )
    ).scalar()
    lo, hi = span.getField("lo"), span.getField("hi")
    step = (hi - lo) / F.lit(float(bins))

    def edge(k):
        """Lower edge of bin k + 1; the one after the last bin is the largest value itself."""
        return F.when(k >= bins, hi).otherwise(lo + k * step)

    guess = F.floor((F.col(value) - lo) / (hi - lo) * F.lit(float(bins)))
    guess = F.greatest(F.least(guess, F.lit(bins - 1).cast("bigint")), F.lit(0).cast("bigint"))
    # The division can miss by one where a value lies on an edge: the edges decide.
    shift = F.when(F.col(value) < edge(F.col("guess")), -1).when(
        (F.col(value) >= edge(F.col("guess") + 1)) & (F.col("guess") < bins - 1), 1
    )
    counts = (
        df.where(F.col(value).isNotNull())
        .withColumn("guess", guess)
        .groupBy((F.col("guess") + 1 + F.coalesce(shift, F.lit(0))).alias("bin"))
        .agg((F.sum(weight) if weight else F.count("*")).alias("n"))
    )
    edges = spark.range(1, bins + 1, numPartitions=1).select(F.col("id").alias("bin"))
    return edges.join(counts, "bin", "left").select(
        "bin",
        edge(F.col("bin") - 1).alias("bin_from"),
        edge(F.col("bin")).alias("bin_to"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
    )
