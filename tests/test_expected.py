"""Hand-computed results on the hand-made extract."""

from datetime import date, datetime

import pytest

from marketmill.marts import QUERIES


def rows(marts, name):
    return [r.asDict() for r in QUERIES[name](marts).collect()]


def by(marts, name, key):
    return {r[key]: r for r in rows(marts, name)}


def test_kpi_summary(fixture_marts):
    (k,) = rows(fixture_marts, "kpi_summary")
    assert k["orders"] == 9
    assert k["unique_customers"] == 6
    assert k["gmv_items"] == 1540.66
    assert k["freight_total"] == 38.82
    assert k["payment_total"] == 1579.48
    assert k["aov"] == pytest.approx(1540.66 / 9)
    assert k["items_per_order"] == 1.0
    assert k["avg_review_score"] == 3.25
    assert k["on_time_delivery_rate"] == 0.25
    assert k["repeat_customer_rate"] == pytest.approx(2 / 6)


def test_order_without_children_keeps_nulls_where_they_mean_something(fixture_marts):
    order = fixture_marts.fact_orders.where("order_id = 'o10'").first()
    assert (order.n_items, order.n_reviews, order.n_payment_lines) == (0, 0, 0)
    assert (order.gmv_items, order.freight_total, order.payment_value_total) == (0.0, 0.0, 0.0)
    assert order.review_score_avg is None
    assert order.payment_type_primary is None
    assert order.delivered_on_time is None


def test_several_reviews_and_payments(fixture_marts):
    order = fixture_marts.fact_orders.where("order_id = 'o02'").first()
    assert (order.review_score_avg, order.n_reviews) == (2.5, 2)
    assert (order.payment_value_total, order.n_payment_lines) == (610.51, 3)
    assert order.payment_type_primary == "voucher"  # alphabetical maximum, not the largest sum


def test_on_time_flag_has_three_values(fixture_marts):
    flags = {r["order_id"]: r["delivered_on_time"] for r in rows(fixture_marts, "on_time_flag")}
    assert flags["o01"] is True
    assert flags["o12"] is True  # exactly at the promise
    assert flags["o02"] is False
    assert flags["o08"] is None


def test_person_takes_one_whole_address(fixture_marts):
    people = by(fixture_marts, "dim_customers", "customer_sk")
    assert people["u1"]["zip_code_prefix"] == "01409"
    assert (people["u2"]["city"], people["u2"]["state"]) == ("sao paulo", "SP")
    assert people["u3"]["n_customer_ids"] == 3
    assert people["u5"]["city"] is None and people["u5"]["state"] == "SP"


def test_calendar(fixture_marts):
    days = by(fixture_marts, "dim_date", "date_sk")
    assert len(days) == 87  # 2017-01-05 .. 2017-04-01
    sunday = days[date(2017, 1, 8)]
    assert (sunday["day_of_week"], sunday["year_month"]) == (0, "2017-01")


def test_coverage(fixture_marts):
    assert rows(fixture_marts, "coverage_monthly") == [
        {"year_month": "2017-01", "orders": 5},
        {"year_month": "2017-03", "orders": 6},
        {"year_month": "2017-04", "orders": 1},
    ]
    assert rows(fixture_marts, "coverage_missing_months") == [{"year_month": "2017-02"}]
    assert rows(fixture_marts, "coverage_thin_months") == [{"year_month": "2017-04", "orders": 1}]
    assert rows(fixture_marts, "coverage_reliable_window") == [
        {"window_start": "2017-01", "window_end": "2017-03"}
    ]
    assert rows(fixture_marts, "coverage_bounds") == [
        {
            "first_order": datetime(2017, 1, 5, 23, 59),
            "last_order": datetime(2017, 4, 1, 9, 0),
            "months_observed": 3,
        }
    ]


def test_integrity(fixture_marts):
    assert rows(fixture_marts, "integrity_counts") == [
        {"orders_total": 12, "delivered_without_delivery_date": 1, "orders_without_review": 5}
    ]
    assert rows(fixture_marts, "integrity_status_contradictions") == [
        {"order_status": "canceled", "n": 1}
    ]


def test_lateness_buckets(fixture_marts):
    found = by(fixture_marts, "lateness_buckets", "bucket")
    shown = {
        b: (r["orders"], r["without_review"], r["avg_review"], r["pct_one_or_two_star"])
        for b, r in found.items()
    }
    assert shown == {
        "0 on time or early": (3, 0, 4.17, 0.0),
        "1 to 7 days late": (2, 0, 2.5, 50.0),
        "8 to 30 days late": (2, 2, None, None),
        "over 30 days late": (1, 0, 2.0, 100.0),
    }


def test_calendar_days_and_both_meanings_of_late(fixture_marts):
    (national,) = rows(fixture_marts, "delivery_national")
    # 1, 10, 10, 15, 15, 44, 44 and 9 days; six of eight late by the timestamp flag
    assert national == {"avg_days_to_deliver": 18.5, "pct_late": 75.0}


def test_review_timing_counts_reviews(fixture_marts):
    found = by(fixture_marts, "review_timing", "bucket")
    first = found["0 on time or early"]
    assert first["orders"] == 4
    # reviews 14 days before, 2 after, 1 before and 1 after the promise
    assert first["avg_days_survey_after_promise"] == -3.0
    assert first["pct_rated_before_delivery"] == 25.0
    assert "8 to 30 days late" not in found


def test_repeat(fixture_marts):
    found = by(fixture_marts, "repeat_segments", "segment")
    assert found["repeat"]["customers"] == 2
    assert found["repeat"]["avg_lifetime_gmv"] == 410.06  # (700.11 + 120.00) / 2 = 410.055
    assert found["one_time"]["customers"] == 4
    assert rows(fixture_marts, "repeat_rate")[0]["repeat_rate"] == 0.3333


def test_order_value(fixture_marts):
    assert rows(fixture_marts, "order_value") == [
        {
            "mean_order_gmv": 171.18,
            "median_order_gmv": 50.0,
            "max_order_gmv": 600.01,
            "mean_over_median": 3.42,
        }
    ]


def test_histogram_drops_zero_and_above_clip(fixture_marts):
    bins = rows(fixture_marts, "fig_order_value_hist")
    assert len(bins) == 60
    assert sum(b["orders"] for b in bins) == 7
    assert bins[0]["bin_from"] == 20.0 and bins[-1]["bin_to"] == 600.0
    assert bins[-1]["orders"] == 1  # the largest value belongs to the last bin


def test_missing_category_two_ways(fixture_marts):
    ten = by(fixture_marts, "top_categories", "category")
    assert ten[None]["gmv"] == 190.0  # p3 and p4: 100.10 + 40.05 + 50.00
    twelve = by(fixture_marts, "kpi_gmv_by_category", "category")
    assert twelve["(unknown)"]["gmv"] == 190.15


def test_seller_concentration_spans_all_statuses(fixture_marts):
    assert rows(fixture_marts, "seller_concentration") == [
        {"sellers_total": 3, "top10_sellers_share": 100.0, "top100_sellers_share": 100.0}
    ]


def test_lost_orders(fixture_marts):
    assert rows(fixture_marts, "status_share") == [
        {"orders": 2, "orders_total": 12, "pct_of_orders": 16.7}
    ]


def test_identities_between_reports(fixture_marts):
    (kpi,) = rows(fixture_marts, "kpi_summary")
    buckets = rows(fixture_marts, "lateness_buckets")
    (integrity,) = rows(fixture_marts, "integrity_counts")
    assert sum(b["orders"] for b in buckets) == (
        kpi["orders"] - integrity["delivered_without_delivery_date"]
    )
    segments = rows(fixture_marts, "repeat_segments")
    assert sum(s["customers"] for s in segments) == (
        rows(fixture_marts, "kpi_repeat_customers")[0]["customers"]
    )
    months = rows(fixture_marts, "coverage_monthly")
    assert sum(m["orders"] for m in months) == integrity["orders_total"]
