import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import get_spark
    os.environ.setdefault("LEDGERLINE_SCRATCH", tempfile.mkdtemp(prefix="ledgerline-tests-"))
    s = get_spark("local[4]", app="ledgerline-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from ledgerline.session import scratch_path
    return lambda name: scratch_path(spark, name)
