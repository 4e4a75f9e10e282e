import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("BENCH_CPUS", "4")
    from wattline.session import get_spark
    s = get_spark("wattline-tests", cpus=4, shuffle_partitions=8)
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
