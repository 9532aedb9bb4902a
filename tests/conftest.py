import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from checks.compare import duck  # noqa: E402
from skylag.session import local_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "tests", shuffle_partitions=4)


@pytest.fixture(scope="session")
def con():
    return duck(SF)


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def silver_rows(spark, sf_dir):
    """Silver departures, written once for all property tests."""
    from checks.etl import silver
    from skylag.session import stage

    return stage(silver(spark, sf_dir, "dep"), "silver")
