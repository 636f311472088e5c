import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.config import Config  # noqa: E402
from strata.plans.medallion import MedallionRun  # noqa: E402
from strata.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", 8, app="strata-tests")
    yield s


@pytest.fixture(scope="session")
def medallion(spark):
    return MedallionRun(spark, SF_SMALL, Config())


@pytest.fixture()
def wh(spark):
    from strata.sources.tables import Warehouse
    return Warehouse(spark, Config())
