"""Each rule on a passing and on a violating star."""

import pytest

from marketmill.plans.quality import (
    ForeignKey,
    NotNull,
    gate,
    relation_rules,
    run_rules,
    standard_rules,
    unique_key,
)
from marketmill.sinks.star_files import star_schema


def star(spark, **rows):
    """Star tables from (column -> value) dicts; columns not named are null."""
    from marketmill.contracts import STAR_COLUMNS

    return {
        name: spark.createDataFrame(
            [[r.get(c) for c in STAR_COLUMNS[name]] for r in rows.get(name, [])],
            star_schema(name),
        )
        for name in STAR_COLUMNS
    }


def order(order_id="o1", **other):
    from datetime import date, datetime

    base = {
        "order_id": order_id,
        "customer_sk": "u1",
        "order_purchase_timestamp": datetime(2018, 1, 5, 10),
        "purchase_date_sk": date(2018, 1, 5),
        "payment_value_total": 1.0,
        "gmv_items": 1.0,
    }
    return base | other


def line(order_id="o1", order_item_id=1, **other):
    base = {
        "order_id": order_id,
        "order_item_id": order_item_id,
        "product_sk": "p1",
        "seller_sk": "s1",
        "price": 1.0,
        "freight_value": 0.0,
    }
    return base | other


def clean(**changed):
    from datetime import date

    base = {
        "fact_orders": [order()],
        "fact_order_items": [line()],
        "dim_customers": [{"customer_sk": "u1"}],
        "dim_products": [{"product_sk": "p1"}],
        "dim_sellers": [{"seller_sk": "s1"}],
        "dim_date": [{"date_sk": date(2018, 1, 5)}],
    }
    return base | changed


def failures(spark, **changed):
    report = run_rules(star(spark, **clean(**changed)), standard_rules() + relation_rules())
    return {r.name: r.violations for r in report.where("not passed").collect()}


def test_clean_star_passes(spark):
    report = run_rules(star(spark, **clean()), standard_rules() + relation_rules())
    assert report.count() == 16
    assert gate(report).first().asDict() == {
        "checks": 16,
        "critical_failures": 0,
        "warnings": 0,
        "publishable": True,
    }


VIOLATIONS = {
    "fact_orders_required_not_null": (
        {"fact_orders": [order(), order("o2", customer_sk=None)]},
        1,
    ),
    "fact_order_items_required_not_null": (
        # one row breaking the rule twice is one violation
        {"fact_order_items": [line(), line("o1", 2, price=None, product_sk=None)]},
        1,
    ),
    "fact_orders_pk_unique": ({"fact_orders": [order(), order(), order()]}, 1),
    "fact_order_items_composite_pk_unique": (
        {"fact_order_items": [line(), line(), line("o1", 2)]},
        1,
    ),
    "dim_customers_pk_unique": (
        {"dim_customers": [{"customer_sk": "u1"}, {"customer_sk": "u1"}]},
        1,
    ),
    "dim_products_pk_unique": (
        # two nulls are one duplicate group as well
        {
            "dim_products": [
                {"product_sk": "p1"},
                {"product_sk": "p1"},
                {"product_sk": None},
                {"product_sk": None},
            ]
        },
        2,
    ),
    "dim_sellers_pk_unique": ({"dim_sellers": [{"seller_sk": "s1"}] * 2}, 1),
    "fact_order_items_non_negative_money": (
        # a null next to the negative must not hide it
        {"fact_order_items": [line(), line("o1", 2, freight_value=-0.01, price=None)]},
        1,
    ),
    "fact_orders_non_negative_money": (
        {"fact_orders": [order(gmv_items=-1.0), order("o2", payment_value_total=-1.0)]},
        2,
    ),
    "fact_order_items_fk_order": (
        {"fact_order_items": [line(), line("gone"), line("gone", 2), line(None)]},
        3,
    ),
    "fact_orders_fk_customers": ({"fact_orders": [order(), order("o2", customer_sk="u9")]}, 1),
    "fact_order_items_fk_products": (
        {"fact_order_items": [line(), line("o1", 2, product_sk="p9")]},
        1,
    ),
    "fact_order_items_fk_sellers": (
        {"fact_order_items": [line(), line("o1", 2, seller_sk="s9")]},
        1,
    ),
}


@pytest.mark.parametrize("name", sorted(VIOLATIONS))
def test_violation_is_counted(spark, name):
    changed, count = VIOLATIONS[name]
    assert failures(spark, **changed)[name] == count


def test_duplicate_date_and_unknown_date(spark):
    from datetime import date

    found = failures(
        spark,
        dim_date=[{"date_sk": date(2018, 1, 6)}, {"date_sk": date(2018, 1, 6)}],
    )
    assert found == {"dim_date_pk_unique": 1, "fact_orders_fk_date": 1}


@pytest.mark.parametrize("year,fresh", [(2015, False), (2016, True), (2019, True), (2020, False)])
def test_freshness_window(spark, year, fresh):
    from datetime import datetime

    found = failures(
        spark, fact_orders=[order(order_purchase_timestamp=datetime(year, 6, 1))]
    )
    assert ("source_freshness_validation" not in found) == fresh


def test_empty_orders_are_not_fresh(spark):
    found = failures(spark, fact_orders=[], fact_order_items=[])
    assert found == {"source_freshness_validation": 1}


def test_warning_does_not_block(spark):
    changed = {"fact_orders": [order(customer_sk="u9")]}
    report = run_rules(star(spark, **clean(**changed)), standard_rules() + relation_rules())
    flags = {r.name: r.flag for r in report.collect()}
    assert flags["fact_orders_fk_customers"] == "WARN"
    assert gate(report).first().publishable


def test_two_references_to_one_parent_share_nothing_twice(spark):
    tables = star(spark, **clean(fact_orders=[order(), order()]))
    second = ForeignKey(
        "again", "fact_order_items", ("order_id",), "orphans", True, "fact_orders", ("order_id",)
    )
    rules = [
        NotNull("has_id", "fact_orders", ("order_id",), "no id"),
        unique_key("fact_orders"),
        *[r for r in standard_rules() if r.name == "fact_order_items_fk_order"],
        second,
    ]
    found = {r.name: r.violations for r in run_rules(tables, rules).collect()}
    assert found == {
        "has_id": 0,
        "fact_orders_pk_unique": 1,
        "fact_order_items_fk_order": 0,
        "again": 0,
    }
