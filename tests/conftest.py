import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgerflow.session import get_session
    s = get_session("local[4]", shuffle_partitions=8, app_name="ledgerflow-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from ledgerflow.sources.adapters import Tables
    return Tables(spark, SF_SMALL)
