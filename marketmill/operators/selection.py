"""Exact order statistics and top-k shares that never gather raw rows in one task."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketmill.functions import from_minor, minor_units


def value_counts(df: DataFrame, money: Column | str) -> DataFrame:
    """The value spectrum of a money column: (v, n), how often each amount occurs, in exact
    ten-thousandths. A hot amount collapses before the shuffle. Count, sum, extremes, order
    statistics and histograms of the column can all be read from it. Nulls are left out."""
    money = F.col(money) if isinstance(money, str) else money
    return (
        df.where(money.isNotNull())
        .groupBy(minor_units(money).alias("v"))
        .agg(F.count("*").alias("n"))
    )


def exact_median(df: DataFrame, money: Column | str, name: str = "median") -> DataFrame:
    """Interpolated median of a money column, as a one-row DataFrame."""
    return median_of(value_counts(df, money), name)


def median_of(counts: DataFrame, name: str = "median") -> DataFrame:
    """Interpolated median of a value spectrum, as a one-row DataFrame.

    The built-in exact percentile ships every distinct value to one task. Here the values are
    cut into ranges of about equal numbers of them, one per shuffle partition, and the first
    round sums the counts per range. Running totals over these few rows tell the ranges that hold
    the middle ranks, one or two neighbours; the second round runs over their values only.
    """
    lower = F.expr("(total - 1) div 2")
    upper = F.expr("total div 2")
    holds_middle = (F.col("before") <= upper) & (lower < F.col("before") + F.col("n"))

    ranges = (
        counts.repartitionByRange("v")
        .groupBy(F.spark_partition_id().alias("range"))
        .agg(F.sum("n").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    )
    so_far = F.sum("n").over(Window.orderBy("lo"))
    middle = (
        ranges.withColumns(
            {"before": so_far - F.col("n"), "total": F.sum("n").over(Window.partitionBy())}
        )
        .where(holds_middle)
        .agg(F.struct(*[F.min(c).alias(c) for c in ("lo", "before", "total")], F.max("hi").alias("hi")))
        .scalar()
    )
    inside = counts.where(F.col("v").between(middle.getField("lo"), middle.getField("hi")))
    running = F.sum("n").over(Window.orderBy("v")) - F.col("n") + middle.getField("before")
    ends = (
        inside.withColumns({"before": running, "total": middle.getField("total")})
        .where(holds_middle)
        .agg(from_minor(F.min("v")).alias("lo"), from_minor(F.max("v")).alias("hi"))
    )
    return ends.select((F.col("lo") + (F.col("hi") - F.col("lo")) * 0.5).alias(name))


def top_with_total(
    groups: DataFrame, key: str, order: Sequence[Column], top: int, *totals: str
) -> DataFrame:
    """The first ``top`` groups in an order, each with the grand totals, from one pass.

    The grand total is one more row of the rollup and sorts to the front, so it travels
    through the same distributed top-k as the groups. The window after it spreads that row
    over at most ``top`` others. Columns: key, every total, ``all_<total>``, ``n_groups``,
    ``rank``.
    """
    level = F.grouping_id()
    head = (
        groups.rollup(key)
        .agg(
            *[F.sum(t).alias(t) for t in totals],
            F.count("*").alias("n_groups"),
            level.alias("level"),
        )
        .orderBy(F.desc("level"), *order)
        .limit(top + 1)
    )
    is_total = F.col("level") == 1

    def everywhere(name: str) -> Column:
        return F.max(F.when(is_total, F.col(name))).over(Window.partitionBy())

    return (
        head.select(
            key,
            *totals,
            *[everywhere(t).alias(f"all_{t}") for t in totals],
            everywhere("n_groups").alias("n_groups"),
            "level",
            (F.row_number().over(Window.orderBy(F.desc("level"), *order)) - 1).alias("rank"),
        )
        .where(~is_total)
        .drop("level")
    )


# Of a smallest row: bits of the hash that tells apart rows of one id, and leading bytes of a text
# id that are compared as a number.
ROW_BITS = 62
LEADING_BYTES = 7
FIXED_WIDTH = ("tinyint", "smallint", "int", "bigint", "date")


def smallest_row(
    df: DataFrame, group: str, by: str, columns: Sequence[str], counted: str
) -> DataFrame:
    """Per group, ``columns`` of the row with the smallest ``by``, taken whole, and the number of
    different ``by`` as ``counted``. Rows of equal ``by`` are told apart by a hash of ``columns``
    (by ``columns`` themselves where ``by`` is text). Null is no ``by``; a group without any keeps
    one of its rows.

    A minimum of text, or of a struct, makes every aggregate a sort of all rows with all columns.
    Here the aggregates hold one number per group: the id and the hash of the row, or the leading
    bytes of a text id. They stay hashed, and ``columns`` are fetched by one equi-join, on the group
    and that number, so that a hot group is spread over its numbers. A text id may share its
    leading bytes with others of its group; those few rows are compared in full after the join,
    which has already put them in order.
    """
    kind = dict(df.dtypes)[by]
    exact = kind in FIXED_WIDTH
    if exact:
        whole = F.unix_date(by) if kind == "date" else F.col(by)
        row = F.xxhash64(*columns).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
        # 63 and 62 bits are below 38 digits; a row without an id comes after all others.
        whole = F.coalesce(whole.cast("decimal(19,0)"), F.lit(Decimal(1 << 63)))
        number = whole * F.lit(Decimal(1 << ROW_BITS)) + row
    else:
        leading = F.rpad(F.hex(F.substring(F.col(by).cast("binary"), 1, LEADING_BYTES)), 2 * LEADING_BYTES, "0")
        number = F.conv(leading, 16, 10).cast("bigint")
    rows = df.select(group, by, *columns, number.alias("number"))
    best = rows.groupBy(F.col(group).alias("best_group")).agg(
        F.min("number").alias("best_number"), F.count_distinct(by).alias(counted)
    )
    same = F.col(group).eqNullSafe(F.col("best_group")) & F.col("number").eqNullSafe(F.col("best_number"))
    found = rows.join(best, same)
    if exact:
        # Rows given twice are one; nothing is exchanged again, and nothing sorted.
        return found.select(group, *columns, counted).distinct()
    pick = F.min(F.struct(by, *columns)).alias("pick")
    return found.groupBy(group, counted).agg(pick).select(group, *[f"pick.{c}" for c in columns], counted)
