"""One data set's raw tables, star tables and every named query over them."""

from __future__ import annotations

import threading
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from marketmill.contracts import RAW_COLUMNS, STAR_COLUMNS
from marketmill.operators.profile import profile_tables, row_counts
from marketmill.plans import insights, kpis, lineage, quality, series, star
from marketmill.sources import footers
from marketmill.sources.raw_files import table_manifest
from marketmill.sources.snapshot import Snapshot

# Tables whose build shuffles, and which many queries read. The others are projections of a
# scan, which Catalyst prunes better than any copy.
SETTLED = ("dim_customers", "dim_products", "fact_orders", "product_totals", "order_values")
ROLLUPS = ("product_totals", "order_values")


@dataclass(frozen=True)
class Limits:
    """Report thresholds, with the published defaults."""

    thin_month_min: int = insights.THIN_MONTH_MIN
    state_min_orders: int = insights.STATE_MIN_ORDERS
    first_year: int = 2016
    last_year: int = 2019
    order_value_clip: float = series.ORDER_VALUE_CLIP
    highlight_state: str = "RJ"
    lost_statuses: tuple[str, ...] = ("canceled", "unavailable")


class Marts:
    """Star tables over raw tables; costly ones are built once, on first use, and kept."""

    def __init__(
        self,
        spark: SparkSession,
        raw: Mapping[str, DataFrame],
        limits: Limits | None = None,
        snapshot: Snapshot | None = None,
        tables: Mapping[str, DataFrame] | None = None,
        star_root: str | None = None,
        raw_root: str | None = None,
    ):
        """Star tables given here are used as they are, others are built from raw. Where the
        tables are written ones, their roots let counts and bounds come from the footers."""
        self.spark = spark
        self.raw = raw
        self.limits = limits or Limits()
        self._snapshot = snapshot
        self._star_root, self._raw_root = star_root, raw_root
        self._tables: dict[str, DataFrame] = dict(tables or {})
        self._locks = {name: threading.Lock() for name in (*STAR_COLUMNS, *ROLLUPS)}

    def plan(self, table: str) -> DataFrame:
        """The lazy build of a table: a star table from raw, a shared rollup from the star."""
        if table == "product_totals":
            return kpis.product_totals(self.fact_order_items, self.fact_orders)
        if table == "order_values":
            return insights.order_values(self.fact_orders)
        return star.BUILDERS[table](self.raw)

    def table(self, name: str) -> DataFrame:
        with self._locks[name]:
            if name not in self._tables:
                df = self.plan(name)
                if self._snapshot is not None and name in SETTLED:
                    df = self._snapshot.settle(name, df)
                self._tables[name] = df
            return self._tables[name]

    def kept_or_planned(self, name: str) -> DataFrame:
        """The table as it is kept if it was built before, else its lazy build. For queries of few
        columns: Catalyst drops from the build every join and rollup they do not use, so they need
        not wait for the whole table to be written."""
        with self._locks[name]:
            return self._tables[name] if name in self._tables else self.plan(name)

    def tables(self, *names: str) -> dict[str, DataFrame]:
        """Several tables, built side by side: one job fills the other's idle tail."""
        with ThreadPoolExecutor(len(names)) as pool:
            return dict(zip(names, pool.map(self.table, names)))

    def settle(self) -> None:
        """Build all settled tables now instead of on first use."""
        self.tables(*SETTLED)

    @property
    def dim_customers(self) -> DataFrame:
        return self.table("dim_customers")

    @property
    def dim_products(self) -> DataFrame:
        return self.table("dim_products")

    @property
    def fact_order_items(self) -> DataFrame:
        return self.table("fact_order_items")

    @property
    def fact_orders(self) -> DataFrame:
        return self.table("fact_orders")

    @property
    def order_stamps(self) -> DataFrame:
        """The orders, for queries that read nothing but when they were placed."""
        return self.kept_or_planned("fact_orders")

    @property
    def product_totals(self) -> DataFrame:
        return self.table("product_totals")

    @property
    def order_values(self) -> DataFrame:
        return self.table("order_values")

    def star_tables(self) -> dict[str, DataFrame]:
        return self.tables(*STAR_COLUMNS)

    def row_counts(self) -> DataFrame:
        if self._star_root:
            return footers.written_counts(self.spark, self._star_root, STAR_COLUMNS)
        return row_counts(self.star_tables())

    def freshness(self) -> DataFrame:
        if self._star_root:
            return footers.written_freshness(self.spark, self._star_root)
        return lineage.source_freshness(self.fact_orders)

    def profile(self) -> DataFrame:
        tables = {t: self.raw[t] for t in RAW_COLUMNS}
        if self._raw_root:
            return footers.written_profile(self.spark, self._raw_root, tables)
        return profile_tables(tables)

    def dq_report(self) -> DataFrame:
        rules = quality.standard_rules(self.limits.first_year, self.limits.last_year)
        return quality.run_rules(self.star_tables(), rules + quality.relation_rules())


def _rollup_items(m: Marts) -> DataFrame:
    return star.items_rollup(m.fact_order_items)


# Every named query. Thresholds come from the limits of the data set.
QUERIES: dict[str, Callable[[Marts], DataFrame]] = {
    # sources and lineage
    "manifest_check": lambda m: table_manifest(m.spark, m.raw),
    "table_profile": lambda m: m.profile(),
    "table_row_counts": lambda m: m.row_counts(),
    "source_freshness": lambda m: m.freshness(),
    # star
    "dim_customers": lambda m: m.plan("dim_customers"),
    "dim_products": lambda m: m.plan("dim_products"),
    "dim_sellers": lambda m: m.plan("dim_sellers"),
    "dim_date": lambda m: m.plan("dim_date"),
    "fact_order_items": lambda m: m.plan("fact_order_items"),
    "payments_rollup": lambda m: star.payments_rollup(m.raw["raw_order_payments"]),
    "reviews_rollup": lambda m: star.reviews_rollup(m.raw["raw_order_reviews"]),
    "items_rollup": _rollup_items,
    "fact_orders": lambda m: m.plan("fact_orders"),
    "on_time_flag": lambda m: star.on_time_flag(m.raw["raw_orders"]),
    # quality
    "dq_report": lambda m: m.dq_report(),
    "dq_gate": lambda m: quality.gate(m.dq_report()),
    # KPIs
    "kpi_summary": lambda m: kpis.kpi_summary(m.fact_orders),
    "kpi_repeat_customers": lambda m: kpis.kpi_repeat_customers(m.fact_orders),
    "kpi_orders_per_month": lambda m: kpis.kpi_orders_per_month(m.fact_orders),
    "kpi_gmv_by_category": lambda m: kpis.kpi_gmv_by_category(
        m.product_totals, m.dim_products
    ),
    "kpi_status_mix": lambda m: kpis.kpi_status_mix(m.fact_orders),
    "kpi_gmv_by_state": lambda m: kpis.kpi_gmv_by_state(m.fact_orders, m.dim_customers),
    "preview_state_gmv": lambda m: kpis.preview_state_gmv(m.fact_orders, m.dim_customers),
    "preview_orders": lambda m: kpis.preview_orders(m.fact_orders),
    "orders_per_customer": lambda m: kpis.orders_per_customer(m.fact_orders),
    "bi_measures": lambda m: kpis.bi_measures(m.product_totals, m.fact_orders),
    "top_products": lambda m: kpis.top_products(m.product_totals),
    "freight_vs_price": lambda m: kpis.freight_vs_price(
        m.product_totals, m.dim_products
    ),
    # insights
    "coverage_bounds": lambda m: insights.coverage_bounds(m.order_stamps),
    "coverage_monthly": lambda m: insights.coverage_monthly(m.order_stamps),
    "coverage_missing_months": lambda m: insights.coverage_missing_months(m.order_stamps),
    "coverage_thin_months": lambda m: insights.coverage_thin_months(
        m.order_stamps, m.limits.thin_month_min
    ),
    "coverage_reliable_window": lambda m: insights.coverage_reliable_window(
        m.order_stamps, m.limits.thin_month_min
    ),
    "integrity_counts": lambda m: insights.integrity_counts(m.fact_orders),
    "integrity_status_contradictions": lambda m: insights.integrity_status_contradictions(
        m.fact_orders
    ),
    "identity_distribution": lambda m: insights.identity_distribution(m.dim_customers),
    "identity_summary": lambda m: insights.identity_summary(m.dim_customers),
    "repeat_segments": lambda m: insights.repeat_segments(m.fact_orders),
    "repeat_rate": lambda m: insights.repeat_rate(m.fact_orders),
    "delivery_national": lambda m: insights.delivery_national(m.fact_orders),
    "on_time_vs_late": lambda m: insights.on_time_vs_late(m.fact_orders),
    "lateness_buckets": lambda m: insights.lateness_buckets(m.fact_orders),
    "delivery_by_state": lambda m: insights.delivery_by_state(
        m.fact_orders, m.dim_customers, m.limits.state_min_orders
    ),
    "review_timing": lambda m: insights.review_timing(
        m.fact_orders, m.raw["raw_order_reviews"]
    ),
    "top_categories": lambda m: insights.top_categories(
        m.product_totals, m.dim_products
    ),
    "top10_categories_share": lambda m: insights.top10_categories_share(
        m.product_totals, m.dim_products
    ),
    "seller_concentration": lambda m: insights.seller_concentration(m.fact_order_items),
    "top_states": lambda m: insights.top_states(m.fact_orders, m.dim_customers),
    "top3_states_share": lambda m: insights.top_states_share(m.fact_orders, m.dim_customers),
    "order_value": lambda m: insights.order_value(m.order_values),
    "payment_mix": lambda m: insights.payment_mix(m.fact_orders),
    "promise_window_by_bucket": lambda m: insights.promise_window_by_bucket(m.fact_orders),
    "state_mix_by_bucket": lambda m: insights.state_mix_by_bucket(
        m.fact_orders, m.dim_customers
    ),
    "status_share": lambda m: insights.status_share(m.fact_orders, m.limits.lost_statuses),
    # chart series
    "fig_coverage_series": lambda m: series.fig_coverage_series(
        m.order_stamps, m.limits.thin_month_min
    ),
    "fig_customer_key": lambda m: series.fig_customer_key(
        m.fact_orders, m.dim_customers, m.raw["raw_orders"]
    ),
    "fig_customer_ids": lambda m: series.fig_customer_ids(m.dim_customers),
    "fig_lateness_series": lambda m: series.fig_lateness_series(m.fact_orders),
    "fig_review_waits": lambda m: series.fig_review_waits(
        m.fact_orders, m.raw["raw_order_reviews"]
    ),
    "fig_state_bubbles": lambda m: series.fig_state_bubbles(
        m.fact_orders, m.dim_customers, m.limits.state_min_orders, m.limits.highlight_state
    ),
    "fig_order_value_hist": lambda m: series.fig_order_value_hist(
        m.order_values, m.limits.order_value_clip
    ),
    "fig_order_value_lines": lambda m: series.fig_order_value_lines(m.order_values),
}
