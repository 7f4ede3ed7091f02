import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = os.environ.get("LAUNCHBOARD_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from launchboard.plans.session import build_session, checkpoint_dir
    s = build_session(master="local[4]", shuffle_partitions=8,
                      extra={"spark.driver.memory": "4g"})
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL


@pytest.fixture(scope="session")
def con(sf_dir):
    from tests.compare import duck
    return duck(sf_dir)
