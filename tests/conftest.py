import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskweave.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
GOLDEN = os.path.join(os.path.dirname(__file__), "golden")


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", app="riskweave-tests", shuffle_partitions=8)
    yield s
    s.stop()
