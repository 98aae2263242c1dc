"""Operators against brute force on small inputs."""

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketmill.functions import day_gap, from_minor, lateness_bucket, minor_units, round_half
from marketmill.operators.calendar import missing_months, monthly_counts
from marketmill.operators.histogram import equal_width_histogram
from marketmill.operators.selection import exact_median, smallest_row, top_with_total


def money_frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v double")


def cents(n, seed, high=1_000_000):
    rng = random.Random(seed)
    return [rng.randrange(high) / 100 for _ in range(n)]


@pytest.mark.parametrize(
    "values",
    [
        [5.0],
        [1.0, 2.0],
        [0.01, 0.02, 1e9],
        cents(1001, 1),
        cents(1000, 2),
        # a third of all rows share one value, next to the middle
        [50.0] * 500 + cents(1001, 3),
        [0.0] * 700 + cents(701, 4),
        [-3.5, -2.25, 10.0, 0.0],
        # neighbours of the middle fall into different buckets
        [0.0, 0.0, 1677.72, 1677.73, 99999.0, 99999.0],
        [1.0, 1.0, 1_000_000.0, 2_000_000.0],
        # the widest range the money type is meant for
        [-4.0e14, 0.01, 0.03, 4.0e14],
        [7.5] * 9,
    ],
)
def test_exact_median(spark, values):
    found = exact_median(money_frame(spark, values), "v").first().median
    assert found == pytest.approx(statistics.median(values), abs=1e-9)


def test_median_of_many_values_with_a_hot_one(spark):
    r = random.Random(4)
    values = [r.randint(-10**9, 10**9) / 100 for _ in range(20_001)]
    for hot in ([], [12.34] * 9_000, [max(values)] * 30_000):
        found = exact_median(money_frame(spark, values + hot).repartition(5), "v").first().median
        assert found == pytest.approx(statistics.median(values + hot), abs=1e-9)


def test_exact_median_skips_nulls_and_may_be_empty(spark):
    assert exact_median(money_frame(spark, [None, 2.0, None, 4.0]), "v").first().median == 3.0
    assert exact_median(money_frame(spark, [None]), "v").first().median is None


@pytest.mark.parametrize(
    "values,bins",
    [(cents(5000, 5), 60), ([0.01, 600.0] + cents(100, 6, 60000), 60), ([7.0] * 9, 4), ([1.0, 2.0, 3.0], 2)],
)
def test_histogram_like_numpy(spark, values, bins):
    found = equal_width_histogram(money_frame(spark, values), "v", bins).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=bins)
    assert [r.n for r in found] == counts.tolist()
    assert [r.bin_from for r in found] == pytest.approx(edges[:-1].tolist())
    assert found[-1].bin_to == pytest.approx(edges[-1])


@pytest.mark.parametrize("low", [0.85, 1.0, 6.0])
def test_histogram_with_values_on_the_edges(spark, low):
    edges = np.linspace(low, 600.0, 61)
    values = np.concatenate([edges, np.nextafter(edges[1:], 0), np.nextafter(edges[:-1], 700)])
    counts, _ = np.histogram(values, bins=60)
    found = equal_width_histogram(money_frame(spark, values.tolist()), "v", 60).orderBy("bin")
    assert [r.n for r in found.collect()] == counts.tolist()


def test_top_with_total(spark):
    df = spark.createDataFrame(
        [("a", 5), ("b", 5), (None, 5), ("d", None), ("e", 9)], "k string, v bigint"
    )
    order = [F.desc_nulls_last("v"), F.asc_nulls_last("k")]
    found = top_with_total(df, "k", order, 4, "v").orderBy("rank").collect()
    assert [(r.rank, r.k, r.v) for r in found] == [(1, "e", 9), (2, "a", 5), (3, "b", 5), (4, None, 5)]
    assert {(r.all_v, r.n_groups) for r in found} == {(24, 5)}
    assert top_with_total(df.where("false"), "k", order, 4, "v").count() == 0


def test_money_is_exact_in_any_order(spark):
    values = cents(20_000, 7) + [0.1, 0.2, 0.3]
    df = money_frame(spark, values)
    exact = sum(round(v * 100) for v in values) / 100
    for parts in (1, 3, 16):
        found = df.repartition(parts).agg(from_minor(F.sum(minor_units("v"))).alias("s"))
        assert found.first().s == exact


def test_round_half_scales_first(spark):
    df = money_frame(spark, [1.005, 0.285, 2.5, -2.5, 0.125])
    found = [r.r for r in df.select(round_half("v", 2).alias("r")).collect()]
    assert found == [1.0, 0.28, 2.5, -2.5, 0.13]
    whole = [r.r for r in df.select(round_half("v", 0).alias("r")).collect()]
    assert whole == [1.0, 0.0, 3.0, -3.0, 0.0]


def test_day_gap_counts_midnights(spark):
    row = spark.sql(
        "select timestamp_ntz'2017-01-05 23:59:00' a, timestamp_ntz'2017-01-06 00:01:00' b"
    ).select(day_gap("a", "b").alias("d"), day_gap("b", "a").alias("back"))
    assert row.first().asDict() == {"d": 1, "back": -1}


def test_bucket_edges(spark):
    df = spark.createDataFrame([(d,) for d in (-5, 0, 1, 7, 8, 30, 31)], "d int")
    found = [r.b for r in df.select(lateness_bucket("d").alias("b")).collect()]
    assert found == (
        ["0 on time or early"] * 2
        + ["1 to 7 days late"] * 2
        + ["8 to 30 days late"] * 2
        + ["over 30 days late"]
    )


def test_missing_months_over_year_end(spark):
    df = spark.sql(
        "select explode(array(date'2016-10-03', date'2017-02-11', date'2016-10-09')) d"
    )
    found = missing_months(monthly_counts(df, "d")).orderBy("month").collect()
    assert [str(r.month) for r in found] == ["2016-11-01", "2016-12-01", "2017-01-01"]


def smallest_rows(rows):
    """{group: (address, different ids)} with the smallest id that is not null."""
    found = {}
    for group, i, *address in rows:
        found.setdefault(group, []).append((i is None, i, tuple(address)))
    out = {}
    for group, members in found.items():
        least = min((m[:2] for m in members if not m[0]), default=(True, None))
        choice = {m[2] for m in members if m[:2] == least}
        out[group] = (choice, len({m[1] for m in members if not m[0]}))
    return out


@pytest.mark.parametrize("kind", ["bigint", "string", "date", "int"])
def test_smallest_row(spark, kind):
    import datetime
    import random

    r = random.Random(kind)

    def an_id():
        n = r.randint(-40, 40)
        if kind == "string":  # many share their first bytes; some are short, empty or not ASCII
            return r.choice(["", "id", "é", "customer", "customer-long-"]) + str(abs(n))[: r.randint(0, 2)]
        return datetime.date(2020, 1, 1) + datetime.timedelta(n) if kind == "date" else n

    ids = [an_id() for _ in range(60)] + [None]
    rows = [(r.choice(["a", "b", "c", None]), i, f"zip{k}", r.choice([None, "x"])) for k, i in enumerate(ids)]
    rows += [("only nulls", None, "z", "q"), ("only nulls", None, "y", None), ("hot", ids[0], "1", "2")]
    rows += rows[:20] + [("hot", ids[0], "1", "2")] * 50
    df = spark.createDataFrame(rows, f"g string, i {kind}, zip string, state string").repartition(7)
    got = smallest_row(df, "g", "i", ("zip", "state"), "n").collect()
    want = smallest_rows(rows)
    if kind == "string":
        key = lambda m: m[1].encode()
        for g in ("a", "b", "c", None):
            least = min((row for row in rows if row[0] == g and row[1] is not None), key=key)[1]
            want[g] = ({row[2:] for row in rows if row[0] == g and row[1] == least}, want[g][1])
    assert len(got) == len(want)
    for row in got:
        choice, n = want[row["g"]]
        assert (row["zip"], row["state"]) in choice and row["n"] == n
    assert smallest_row(df.limit(0), "g", "i", ("zip", "state"), "n").count() == 0


def test_smallest_row_of_fixed_width_ids_is_never_sorted_by_an_aggregate(spark):
    df = spark.createDataFrame([(1, 2, "x")], "g bigint, i bigint, c string")
    plan = smallest_row(df, "g", "i", ("c",), "n")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
