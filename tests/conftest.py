import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

from recordflow.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "8", shuffle_partitions="8")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def inputs(spark):
    from recordflow.catalog.registry import Inputs

    return Inputs(spark, SF_DIR)


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""

    def collect(df, *cols):
        picked = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
