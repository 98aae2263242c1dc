"""Raw files, written stars, publication."""

import csv
import json
from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__ as registry
from marketmill.contracts import RAW_COLUMNS, RAW_FILE_BY_TABLE, STAR_COLUMNS
from marketmill.marts import QUERIES, Limits, Marts
from marketmill.operators.profile import preview, profile_tables
from marketmill.plans import pipeline, quality
from marketmill.plans.star import build_star
from marketmill.sinks import publish, star_files
from marketmill.sources import raw_files
from marketmill.sources.standin import StandinRaw
from tests import raw_fixture
from tests.conftest import SMALL
from tests.raw_fixture import PREFIX


def json_rows(folder):
    return [
        json.loads(line)
        for part in sorted(Path(folder).glob("part-*.json"))
        for line in part.read_text().splitlines()
    ]


def raw_of(run):
    return f"{publish.version_root(run[0], run[1].version)}/raw"


def test_quoted_line_break_and_leading_zero(spark, raw_folder):
    raw = raw_files.read_raw(spark, raw_folder, PREFIX)
    text = raw["raw_order_reviews"].where("review_id = 'r01'").first().review_comment_message
    assert text == 'line one\nline two, with a "quote"'
    assert raw["raw_order_reviews"].count() == 8
    assert raw["raw_customers"].where("customer_id = 'c01'").first().customer_zip_code_prefix == "01409"
    assert {t for _, t in raw["raw_order_items"].dtypes} == {"string"}


@pytest.mark.parametrize(
    "style", [{"encoding": "utf-8-sig"}, {"quoting": csv.QUOTE_ALL}], ids=["byte order mark", "all quoted"]
)
def test_file_style_does_not_matter(spark, raw_folder, tmp_path, style):
    raw_fixture.write(tmp_path, **style)
    plain = raw_files.read_raw(spark, raw_folder, PREFIX)
    styled = raw_files.read_raw(spark, str(tmp_path), PREFIX)
    for table, df in plain.items():
        assert styled[table].columns == df.columns
        assert sorted(map(repr, styled[table].collect())) == sorted(map(repr, df.collect()))
    tables, failed = raw_files.load_all(spark, str(tmp_path))
    assert failed == {}
    assert tables["product_category_name_translation"].columns[0] == "product_category_name"


def test_manifest_names_what_is_missing(spark, tmp_path):
    raw_fixture.write(tmp_path)
    (tmp_path / f"{PREFIX}_sellers_dataset.csv").unlink()
    found = {r.table_name: r.found for r in raw_files.file_manifest(spark, str(tmp_path), PREFIX).collect()}
    assert found["raw_sellers"] is False and found["raw_orders"] is True
    assert found["raw_geolocation"] is False  # expected, not required
    with pytest.raises(FileNotFoundError, match="sellers_dataset"):
        raw_files.read_raw(spark, str(tmp_path), PREFIX)


def test_missing_column_is_named(spark, tmp_path):
    raw_fixture.write(tmp_path, sellers=[r[:3] for r in raw_fixture.SELLERS])
    with pytest.raises(ValueError, match="raw_sellers lacks columns: seller_state"):
        raw_files.read_raw(spark, str(tmp_path), PREFIX)


def test_part_files_in_a_folder_are_one_table(spark, tmp_path):
    raw_fixture.write(tmp_path)
    name = f"{PREFIX}_sellers_dataset.csv"
    lines = (tmp_path / name).read_text().splitlines()
    (tmp_path / name).unlink()
    (tmp_path / name).mkdir()
    (tmp_path / name / "part-0.csv").write_text("\n".join(lines[:2]) + "\n")
    (tmp_path / name / "part-1.csv").write_text("\n".join([lines[0], *lines[2:]]) + "\n")
    assert raw_files.read_raw(spark, str(tmp_path), PREFIX)["raw_sellers"].count() == 3
    row = raw_files.file_manifest(spark, str(tmp_path), PREFIX).where("table_name = 'raw_sellers'")
    assert row.first().n_files == 2


def test_load_all_goes_on_after_a_bad_file(spark, tmp_path):
    raw_fixture.write(tmp_path)
    (tmp_path / "empty.csv").write_text("")
    tables, failed = raw_files.load_all(spark, str(tmp_path))
    assert len(tables) == 8 and set(failed) == {"empty"}
    assert tables[f"{PREFIX}_orders_dataset"].count() == 12


def test_load_all_needs_a_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        raw_files.load_all(spark, str(tmp_path))


def test_landing_keeps_text_and_origin(spark, fixture_run):
    landed = raw_files.read_landed(spark, raw_of(fixture_run))
    row = landed["raw_orders"].where("order_id = 'o01'").first()
    assert row[raw_files.LANDED_FROM].endswith(f"{PREFIX}_orders_dataset.csv")
    assert row.order_purchase_timestamp == "2017-01-05 23:59:00"


def test_landed_or_source(spark, raw_folder, fixture_run, tmp_path):
    landed = raw_files.load_raw_or_source(spark, raw_of(fixture_run), raw_folder, PREFIX)
    assert raw_files.LANDED_FROM in landed["raw_orders"].columns
    source = raw_files.load_raw_or_source(spark, str(tmp_path / "none"), raw_folder, PREFIX)
    assert raw_files.LANDED_FROM not in source["raw_orders"].columns


def test_profile_counts_what_is_there(spark, raw_folder):
    raw = raw_files.read_raw(spark, raw_folder, PREFIX)
    found = {
        r.column_name: (r.n_rows, r.n_non_null)
        for r in profile_tables({"raw_orders": raw["raw_orders"]}).collect()
    }
    assert found["order_id"] == (12, 12)
    assert found["order_delivered_customer_date"] == (12, 9)
    assert preview(raw["raw_orders"], 5).count() == 5


def test_published_star_is_on_contract(spark, fixture_run):
    lake, run = fixture_run
    assert run.published and publish.current_version(spark, lake) == run.version
    tables = star_files.read_star(spark, publish.version_root(lake, run.version))
    for name, columns in STAR_COLUMNS.items():
        assert dict(tables[name].dtypes) == columns


def test_written_star_equals_lazy_star(spark, fixture_run):
    lake, run = fixture_run
    lazy = build_star(raw_files.read_landed(spark, raw_of(fixture_run)))
    for name, df in lazy.items():
        written = run.tables[name]
        assert written.exceptAll(df).count() == 0 and df.exceptAll(written).count() == 0


def test_csv_copy_has_header_and_all_rows(spark, fixture_run):
    lake, run = fixture_run
    root = publish.version_root(lake, run.version)
    copy = raw_files.read_csv(spark, f"{root}/csv/fact_order_items")
    assert copy.columns == list(STAR_COLUMNS["fact_order_items"]) and copy.count() == 10


def test_metadata_and_report_files(fixture_run):
    lake, run = fixture_run
    root = publish.version_root(lake, run.version)
    meta = {r["table_name"]: r for r in json_rows(f"{root}/pipeline_metadata")}
    assert meta["fact_orders"]["rows"] == 12
    assert meta["fact_orders"]["n_orders"] == 12
    assert meta["dim_sellers"]["min_order_purchase_timestamp"] is None
    report = json_rows(f"{root}/dq_report")
    assert len(report) == 24 and all(r["passed"] for r in report)
    assert all("checked_at" in r for r in report)
    gate = json_rows(f"{root}/dq_gate")
    assert [(r["checks"], r["critical_failures"]) for r in gate] == [(24, 0)]


def test_bad_build_is_not_published(spark, tmp_path):
    source, lake = tmp_path / "src", str(tmp_path / "lake")
    source.mkdir()
    raw_fixture.write(source)
    good = pipeline.run_pipeline(spark, str(source), lake, PREFIX)
    bad_items = raw_fixture.ITEMS + [("gone", 1, "p1", "s1", "2017-01-09 00:00:00", "-1.00", "0")]
    raw_fixture.write(source, order_items=bad_items)
    bad = pipeline.run_pipeline(spark, str(source), lake, PREFIX)
    assert good.published and not bad.published
    assert publish.current_version(spark, lake) == good.version
    with pytest.raises(pipeline.QualityGateFailed) as failed:
        pipeline.require_published(bad)
    assert "fact_order_items_fk_order" in str(failed.value)
    assert "fact_order_items_non_negative_money" in str(failed.value)
    history = {r.version: r for r in pipeline.gate_history(spark, lake).collect()}
    assert set(history) == {good.version, bad.version}
    assert history[good.version].published and history[good.version].critical_failures == 0
    assert not history[bad.version].published and history[bad.version].critical_failures == 2
    shown = json_rows(f"{publish.version_root(lake, bad.version)}/raw_preview")
    assert {r["table_name"] for r in shown} == set(RAW_COLUMNS)
    assert max(Counter(r["table_name"] for r in shown).values()) == 5


def test_rejected_build_changes_no_report(spark, tmp_path):
    """Other reviews and a line without an order: the published reports stay as they are."""
    source, lake = tmp_path / "src", str(tmp_path / "lake")
    source.mkdir()
    raw_fixture.write(source)
    good = pipeline.run_pipeline(spark, str(source), lake, PREFIX)
    limits = Limits(3, 1, 1995, 2001, 600.0, "NATION_7")

    def every_section():
        marts = pipeline.current_marts(spark, lake, limits)
        names = [n for group in pipeline.SECTIONS.values() for n in group]
        return {n: sorted(map(repr, QUERIES[n](marts).collect())) for n in names}

    before = every_section()
    worst = [raw_fixture.REVIEWS[0], *[(*r[:2], 1, *r[3:]) for r in raw_fixture.REVIEWS[1:]]]
    bad_items = raw_fixture.ITEMS + [("gone", 1, "p1", "s1", "2017-01-09 00:00:00", "1.00", "0")]
    raw_fixture.write(source, order_items=bad_items, order_reviews=worst)
    bad = pipeline.run_pipeline(spark, str(source), lake, PREFIX)
    assert good.published and not bad.published
    assert every_section() == before


def test_too_fine_money_is_reported_with_table_and_count(spark, tmp_path):
    source, lake = tmp_path / "src", str(tmp_path / "lake")
    source.mkdir()
    items = raw_fixture.ITEMS + [("o01", 9, "p1", "s1", "2017-01-09 00:00:00", "1.00005", "0")] * 2
    raw_fixture.write(source, order_items=items)
    run = pipeline.run_pipeline(spark, str(source), lake, PREFIX)
    assert not run.published
    with pytest.raises(pipeline.QualityGateFailed, match="raw_order_items_rows_intact: .*: 2"):
        pipeline.require_published(run)


def test_damaged_rows_are_not_published(spark, tmp_path):
    source, lake = tmp_path / "src", str(tmp_path / "lake")
    source.mkdir()
    raw_fixture.write(source)
    payments = source / f"{PREFIX}_order_payments_dataset.csv"
    header, first, *rest = payments.read_text().splitlines()
    cells = first.split(",")
    value = header.split(",").index("payment_value")
    wrong = ",".join([*cells[:value], "many", *cells[value + 1 :]])
    payments.write_text("\n".join([header, ",".join(cells[:2]), first + ",more", wrong, *rest]) + "\n")
    run = pipeline.run_pipeline(spark, str(source), lake, PREFIX)
    assert not run.published and publish.current_version(spark, lake) is None
    with pytest.raises(pipeline.QualityGateFailed) as failed:
        pipeline.require_published(run)
    assert str(failed.value) == "raw_order_payments_rows_intact: damaged or uncastable rows: 3"


def test_reports_without_reviews_say_so(spark, fixture_marts, tmp_path):
    raw = {t: df for t, df in fixture_marts.raw.items() if t != "raw_order_reviews"}
    marts = Marts(spark, raw, fixture_marts.limits, tables=fixture_marts.star_tables())
    pipeline.write_insights(marts, str(tmp_path))
    row = json_rows(tmp_path / "review_timing" / "review_timing")[0]
    assert row == {"available": False, "reason": "no raw_order_reviews"}


def test_manifest_looks_where_files_are_read(spark, tmp_path):
    folder = tmp_path / "parent.csv"
    (folder / "below").mkdir(parents=True)
    raw_fixture.write(folder / "below")
    with pytest.raises(FileNotFoundError, match="orders_dataset"):
        raw_files.require_files(spark, str(folder), PREFIX)
    raw_fixture.write(folder)
    raw_files.require_files(spark, str(folder), PREFIX)
    assert raw_files.read_raw(spark, str(folder), PREFIX)["raw_orders"].count() == 12


def test_half_landed_folder_is_an_error(spark, raw_folder, fixture_run, tmp_path):
    landed = raw_files.read_landed(spark, raw_of(fixture_run))
    landed["raw_orders"].write.parquet(str(tmp_path / "raw_orders"))
    with pytest.raises(FileNotFoundError, match="raw_sellers"):
        raw_files.load_raw_or_source(spark, str(tmp_path), raw_folder, PREFIX)


def test_table_manifest_names_a_missing_table(spark, tmp_path):
    for base in ("orders", "customer", "nation", "part", "supplier", "events"):
        spark.read.parquet(f"{SMALL}/{base}.parquet").write.parquet(str(tmp_path / f"{base}.parquet"))
    rows = raw_files.table_manifest(spark, StandinRaw(spark, str(tmp_path))).collect()
    lacking = {r.table_name for r in rows if not r.found}
    assert lacking == {"raw_geolocation", "raw_orders", "raw_order_items", "raw_order_payments"}


def test_newest_publication_wins(spark, tmp_path):
    lake = str(tmp_path)
    assert publish.current_version(spark, lake) is None
    publish.publish(spark, lake, "b")
    publish.publish(spark, lake, "a")
    assert publish.current_version(spark, lake) == "a"
    assert publish.history(spark, lake) == ["b", "a"]


def test_of_two_builds_that_race_one_is_published(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    lake = str(tmp_path)
    publish.publish(spark, lake, "first")
    began_from = publish.newest(spark, lake)

    def attempt(version):
        try:
            publish.publish(spark, lake, version, began_from)
            return version
        except publish.PublicationConflict:
            return None

    with ThreadPoolExecutor(4) as pool:
        done = [v for v in pool.map(attempt, ["w", "x", "y", "z"]) if v]
    assert len(done) == 1 and publish.current_version(spark, lake) == done[0]
    assert publish.history(spark, lake) == ["first", *done]
    assert list((tmp_path / "publishing").glob("*-*")) == []


def test_an_older_build_that_ends_later_is_refused(spark, tmp_path):
    lake = str(tmp_path)
    older = publish.newest(spark, lake)  # began before anything was published
    publish.publish(spark, lake, "newer", publish.newest(spark, lake))
    with pytest.raises(publish.PublicationConflict, match="older began from None, but newer"):
        publish.publish(spark, lake, "older", older)
    assert publish.current_version(spark, lake) == "newer"
    publish.publish(spark, lake, "older", publish.newest(spark, lake))  # after a look at the newer one
    assert publish.history(spark, lake) == ["newer", "older"]


def test_duplicate_translation_breaks_the_product_key(spark, tmp_path):
    raw_fixture.write(
        tmp_path, product_category=raw_fixture.TRANSLATION + [("beleza", "health")]
    )
    run = pipeline.run_pipeline(spark, str(tmp_path), str(tmp_path / "lake"), PREFIX)
    failed = {r.name for r in run.report.where("not passed").collect()}
    assert failed == {"dim_products_pk_unique"} and not run.published


def test_star_off_contract_or_incomplete(spark, tmp_path, fixture_run):
    tables = fixture_run[1].tables
    root = str(tmp_path)
    for name, df in tables.items():
        if name != "dim_sellers":
            star_files.write_table(df, root, name)
    with pytest.raises(FileNotFoundError, match="dim_sellers"):
        star_files.read_star(spark, root)
    star_files.write_table(tables["dim_sellers"].drop("state"), root, "dim_sellers")
    with pytest.raises(ValueError, match="state missing"):
        star_files.read_star(spark, root)


def test_views(spark, fixture_run, tmp_path):
    lake, run = fixture_run
    counts = {r.table_name: r.n for r in star_files.register_views(run.tables).collect()}
    assert counts["fact_orders"] == 12
    assert spark.sql("select count(*) n from fact_order_items").first().n == 10
    root = publish.version_root(lake, run.version)
    names = star_files.register_found(spark, root, f"{root}/raw")
    assert set(names) == set(STAR_COLUMNS) | {"raw_orders", "raw_order_items", "raw_customers"}
    assert star_files.register_found(spark, str(tmp_path)) == []


def test_insight_report_files(fixture_marts, tmp_path):
    names = pipeline.write_insights(fixture_marts, str(tmp_path), "s3a://lake/star")
    assert len(names) == 1 + sum(len(s) for s in pipeline.SECTIONS.values())
    header = json_rows(tmp_path / "run")[0]
    assert header["star_dir"] == "s3a://lake/star" and header["generated_at_utc"].endswith("Z")
    assert header["delivered_filter"] == "order_status = delivered"
    assert json_rows(tmp_path / "kpis" / "kpi_summary")[0]["gmv_items"] == 1540.66
    months = json_rows(tmp_path / "coverage" / "coverage_monthly")
    assert [m["year_month"] for m in months] == ["2017-01", "2017-03", "2017-04"]


def test_tables_through_csv_give_the_same_reports(spark, tmp_path):
    """The test tables written as a raw extract, landed, built and read back as text."""
    source, lake = tmp_path / "src", str(tmp_path / "lake")
    standin = StandinRaw(spark, SMALL)
    for table in RAW_COLUMNS:
        name = RAW_FILE_BY_TABLE[table].file_name(PREFIX)
        standin[table].write.option("header", True).csv(str(source / name))
    run = pipeline.run_pipeline(
        spark, str(source), lake, PREFIX, quality.standard_rules(1995, 2001)
    )
    # The test lines repeat their key; that must stop publication, and nothing else does.
    assert [r.name for r in run.report.where("not passed").collect()] == [
        "fact_order_items_composite_pk_unique"
    ]
    assert not run.published
    landed = raw_files.read_landed(spark, f"{publish.version_root(lake, run.version)}/raw")
    through_csv = Marts(spark, landed, registry.TEST_LIMITS, tables=run.tables)
    direct = registry.marts_for(spark, SMALL)
    for names in pipeline.SECTIONS.values():
        for name in names:
            a, b = QUERIES[name](through_csv), QUERIES[name](direct)
            assert a.columns == b.columns
            assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect())), name
