"""The whole run: land raw files, build and write the star, audit it, publish it, report."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketmill.marts import QUERIES, Limits, Marts
from marketmill.operators.profile import previews
from marketmill.plans import quality
from marketmill.plans.kpis import DELIVERED
from marketmill.sinks import publish, reports, star_files
from marketmill.sources import raw_files
from marketmill.sources.snapshot import Snapshot

UTC_STAMP = "yyyy-MM-dd'T'HH:mm:ss'Z'"
NEED_REVIEWS = ("review_timing", "fig_review_waits")

# Report sections by group, all of them registered queries.
SECTIONS: dict[str, tuple[str, ...]] = {
    "kpis": (
        "kpi_summary",
        "kpi_orders_per_month",
        "kpi_gmv_by_category",
        "kpi_status_mix",
        "kpi_gmv_by_state",
    ),
    "coverage": (
        "coverage_bounds",
        "coverage_monthly",
        "coverage_missing_months",
        "coverage_thin_months",
        "coverage_reliable_window",
    ),
    "integrity": ("integrity_counts", "integrity_status_contradictions"),
    "customer_identity": ("identity_summary", "identity_distribution"),
    "repeat_behaviour": ("repeat_segments", "repeat_rate"),
    "delivery_and_reviews": (
        "delivery_national",
        "on_time_vs_late",
        "lateness_buckets",
        "delivery_by_state",
    ),
    "review_timing": ("review_timing",),
    "concentration": (
        "top_categories",
        "top10_categories_share",
        "seller_concentration",
        "top_states",
        "top3_states_share",
    ),
    "order_value": ("order_value", "payment_mix"),
    "charts": (
        "fig_coverage_series",
        "fig_customer_key",
        "fig_customer_ids",
        "fig_lateness_series",
        "fig_review_waits",
        "fig_state_bubbles",
        "fig_order_value_hist",
        "fig_order_value_lines",
    ),
}


@dataclass(frozen=True)
class Run:
    version: str
    published: bool
    report: DataFrame
    tables: dict[str, DataFrame]


class QualityGateFailed(RuntimeError):
    pass


def run_pipeline(
    spark: SparkSession,
    source: str,
    lake: str,
    prefix: str,
    rules: Sequence[quality.Rule] | None = None,
    csv: bool = False,
    limits: Limits | None = None,
) -> Run:
    """Stages in order; each hands over through written tables, and a failure stops the run.

    Everything lands below the build's own version, the raw layer too, so that a build that is
    not published changes nothing readers see. The audit report and the gate's figures are
    written with the build either way; publication needs zero critical failures, and that no other
    build has been published since this one began.
    """
    stamp = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S")
    version = f"{stamp}-{uuid.uuid4().hex[:8]}"
    root = publish.version_root(lake, version)
    began_from = publish.newest(spark, lake)

    raw = raw_files.land_raw(spark, source, prefix, f"{root}/raw")
    # Rows that cannot be read as what they should be end the run before a cast does.
    reports.write_section(quality.raw_findings(raw), root, "raw_report")
    reports.write_section(previews(raw), root, "raw_preview")
    intact = spark.read.json(f"{root}/raw_report")
    if not intact.where("not passed").isEmpty():
        return Run(version, False, _audit(spark, intact, root), {})
    tables = star_files.write_star(raw, root, csv)
    reports.write_section(star_files.pipeline_metadata(tables, root), root, "pipeline_metadata")

    limits = limits or Limits()
    if rules is None:
        rules = quality.standard_rules(limits.first_year, limits.last_year)
        rules += quality.relation_rules()
    report = _audit(spark, quality.run_rules(tables, rules).unionByName(intact), root)
    allowed = _publishable(spark, root)
    if allowed:
        publish.publish(spark, lake, version, began_from)
    return Run(version, allowed, report, tables)


def _audit(spark: SparkSession, findings: DataFrame, root: str) -> DataFrame:
    """The findings and the gate's figures as written, so that nothing is audited twice."""
    reports.write_section(reports.stamped(findings), root, "dq_report")
    report = spark.read.json(f"{root}/dq_report")
    reports.write_section(reports.stamped(quality.gate(report)), root, "dq_gate")
    return report


def _publishable(spark: SparkSession, root: str) -> bool:
    return bool(spark.read.json(f"{root}/dq_gate").first().publishable)


def gate_history(spark: SparkSession, lake: str) -> DataFrame:
    """The gate's figures of every build, published or not, by version: version, checks,
    critical_failures, warnings, publishable, checked_at, published. Builds that ended before their
    audit have none."""
    figures = "checks bigint, critical_failures bigint, warnings bigint, publishable boolean, checked_at timestamp"
    folder = F.regexp_extract(F.col("_metadata.file_path"), "/versions/([^/]+)/dq_gate/", 1)
    published = publish.log(spark, lake).select("version", F.lit(True).alias("published")).distinct()
    return (
        spark.read.schema(figures)
        .json(f"{lake}/versions/*/dq_gate")
        .select(folder.alias("version"), "*")
        .join(published, "version", "left")
        .withColumn("published", F.coalesce("published", F.lit(False)))
        .orderBy("version")
    )


def require_published(run: Run) -> Run:
    """Raise, naming the failed checks, unless the run was published."""
    if not run.published:
        failed = run.report.where("critical and not passed").select("name", "detail")
        # At most one row per rule.
        lines = [f"{r.name}: {r.detail}" for r in failed.orderBy("name").collect()]
        raise QualityGateFailed("; ".join(lines))
    return run


def current_marts(
    spark: SparkSession,
    lake: str,
    limits: Limits | None = None,
    snapshot: Snapshot | None = None,
) -> Marts:
    """Marts over the current published star and the raw tables it was built from.

    With a snapshot, the product totals that several reports share are kept as well.
    """
    version = publish.current_version(spark, lake)
    if version is None:
        raise FileNotFoundError(f"nothing published in {lake}")
    root = publish.version_root(lake, version)
    tables = star_files.read_star(spark, root)
    raw = raw_files.read_landed(spark, f"{root}/raw")
    return Marts(spark, raw, limits, snapshot, tables, root, f"{root}/raw")


def report_header(spark: SparkSession, star_dir: str) -> DataFrame:
    """When and from which star the report was made, and which orders it counts."""
    return spark.range(1, numPartitions=1).select(
        F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), UTC_STAMP).alias(
            "generated_at_utc"
        ),
        F.lit(star_dir).alias("star_dir"),
        F.lit(f"order_status = {DELIVERED}").alias("delivered_filter"),
    )


def unavailable(spark: SparkSession, why: str) -> DataFrame:
    return spark.range(1, numPartitions=1).select(
        F.lit(False).alias("available"), F.lit(why).alias("reason")
    )


def write_insights(marts: Marts, out: str, star_dir: str = "") -> list[str]:
    """Every report section as a folder ``<group>/<section>`` of JSON lines, and ``run``, the
    report's header. Sections that need reviews say so where no reviews are at hand."""
    sections = {"run": report_header(marts.spark, star_dir)}
    for group, names in SECTIONS.items():
        for name in names:
            lacking = name in NEED_REVIEWS and "raw_order_reviews" not in marts.raw
            sections[f"{group}/{name}"] = (
                unavailable(marts.spark, "no raw_order_reviews") if lacking else QUERIES[name](marts)
            )
    return reports.write_report(sections, out)
