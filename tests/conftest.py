import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import get_session

    import tempfile

    s = get_session(master="local[*]", shuffle_partitions=8, app="ledgerline-tests", driver_memory="4g",
                    warehouse_dir=tempfile.mkdtemp(prefix="ledgerline-wh-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL


@pytest.fixture(scope="session")
def src(spark, sf_dir):
    from ledgerline.registry import sources_for

    return sources_for(spark, sf_dir)
