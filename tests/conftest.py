import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from kpiloom.session import build_session  # noqa: E402
from kpiloom.store import TableStore  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        **{"spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "4"},
    )
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


@pytest.fixture(scope="session")
def sample(spark):
    """The refresh of the smallest data folder, shared by the tests that only read it."""
    from kpiloom.plans.catalog import warehouse

    return warehouse(spark, SF_DIR)
