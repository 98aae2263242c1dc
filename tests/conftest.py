import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marketmill.session import local_session  # noqa: E402
from tests import raw_fixture  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw_folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    raw_fixture.write(folder)
    return str(folder)


@pytest.fixture(scope="session")
def fixture_run(spark, raw_folder, tmp_path_factory):
    """The hand-made extract taken through the whole pipeline."""
    from marketmill.plans.pipeline import run_pipeline

    lake = str(tmp_path_factory.mktemp("lake"))
    run = run_pipeline(spark, raw_folder, lake, raw_fixture.PREFIX, csv=True)
    return lake, run


@pytest.fixture(scope="session")
def fixture_marts(spark, fixture_run):
    from marketmill.marts import Limits
    from marketmill.plans.pipeline import current_marts

    limits = Limits(
        thin_month_min=3,
        state_min_orders=1,
        first_year=1995,
        last_year=2001,
        order_value_clip=600.0,
        highlight_state="NATION_7",
    )
    return current_marts(spark, fixture_run[0], limits)
