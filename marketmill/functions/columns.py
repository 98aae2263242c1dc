"""Column helpers shared by every mart. All are built-in expressions, none is a UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money is summed as whole ten-thousandths: a bigint sum is exact, does not depend on the
# order in which partitions arrive, and stays in the hash aggregate's fixed-width buffer.
MINOR_PER_UNIT = 10_000

# Lateness bucket upper edges (days after the promised date) and report labels.
BUCKET_EDGES = (0, 7, 30)
BUCKET_LABELS = (
    "0 on time or early",
    "1 to 7 days late",
    "8 to 30 days late",
    "over 30 days late",
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fits_minor(value: Column) -> Column:
    """Whether a double has no more than four decimals: the double nearest to such a decimal is what
    its ten-thousandths divide to. Null fits."""
    whole = F.rint(value * F.lit(float(MINOR_PER_UNIT)))
    return value.isNull() | (whole / F.lit(float(MINOR_PER_UNIT)) == value)


def minor_units(c: Column | str) -> Column:
    """Money as a whole number of ten-thousandths; an amount that is finer raises an error."""
    value = _col(c)
    whole = F.rint(value * F.lit(float(MINOR_PER_UNIT)))
    survives = fits_minor(value)
    finer = F.raise_error(F.concat(F.lit("money finer than four decimals: "), value.cast("string")))
    return F.when(survives, whole.cast("bigint")).otherwise(finer.cast("bigint"))


def from_minor(c: Column | str) -> Column:
    return _col(c) / F.lit(float(MINOR_PER_UNIT))


def money_sum(c: Column | str) -> Column:
    """Exact sum of a money column, as double."""
    return from_minor(F.sum(minor_units(c)))


# A quotient is summed as a whole number of 2^-bits, whose high and low halves are two bigint sums:
# exact, the same for any order and partitioning of the rows, and in the hash aggregate's
# fixed-width buffer. Either half has room for 10^12 rows.
LOW_BITS = 20


def _halves(c: Column | str, bits: int) -> tuple[Column, Column]:
    whole = F.floor(_col(c) * F.lit(float(1 << bits)) + 0.5).cast("bigint")
    return F.shiftright(whole, LOW_BITS), whole.bitwiseAND(F.lit((1 << LOW_BITS) - 1))


def quotient_sums(c: Column | str, name: str, bits: int = 40) -> list[Column]:
    """The two sums of a column of quotients, ``<name>_high`` and ``<name>_low``; sums of such sums
    can be taken further."""
    high, low = _halves(c, bits)
    return [F.sum(high).alias(f"{name}_high"), F.sum(low).alias(f"{name}_low")]


def _average(high: Column, low: Column, n: Column, bits: int) -> Column:
    total = high.cast("decimal(38,0)") * F.lit(1 << LOW_BITS) + low
    return F.try_divide(total.cast("double") / F.lit(float(1 << bits)), n)


def average_of_sums(name: str, n: Column | str, bits: int = 40) -> Column:
    """The average from ``quotient_sums``, null where nothing was summed."""
    return _average(F.col(f"{name}_high"), F.col(f"{name}_low"), _col(n), bits)


def stable_average(c: Column | str, bits: int = 40) -> Column:
    """Average of a column of quotients, the same for any order and partitioning of the rows."""
    high, low = _halves(c, bits)
    return _average(F.sum(high), F.sum(low), F.count(_col(c)), bits)


def round_half(c: Column | str, digits: int) -> Column:
    """Scale, round half away from zero, scale back: round(1.005, 2) is 1.0, not 1.01."""
    scale = F.lit(float(10**digits))
    return F.round(_col(c) * scale, 0) / scale


def percent(part: Column, whole: Column, digits: int | None = None) -> Column:
    """100 * part / whole in double arithmetic, null where the whole is zero."""
    share = F.try_divide(F.lit(100.0) * part, whole)
    return share if digits is None else round_half(share, digits)


def day_gap(start: Column | str, end: Column | str) -> Column:
    """Midnights crossed from start to end (23:59 to 00:01 is one day)."""
    return F.datediff(_col(end), _col(start)).cast("bigint")


def month_start(c: Column | str) -> Column:
    """First day of the month. Grouping on this date is cheaper than on a formatted string."""
    return F.trunc(_col(c), "month")


def month_label(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM")


def _bucketed(days: Column, values: tuple) -> Column:
    first, week, month = BUCKET_EDGES
    return (
        F.when(days <= first, F.lit(values[0]))
        .when(days <= week, F.lit(values[1]))
        .when(days <= month, F.lit(values[2]))
        .otherwise(F.lit(values[3]))
    )


def lateness_bucket(days: Column | str, labels: tuple[str, ...] = BUCKET_LABELS) -> Column:
    return _bucketed(_col(days), labels)


def bucket_order(days: Column | str) -> Column:
    return _bucketed(_col(days), (1, 2, 3, 4))
