import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from meteoframe.session import get_session

    s = get_session("local[4]", shuffle_partitions=4, app_name="meteoframe-tests", driver_memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from tests.compare import duckdb_connection

    return duckdb_connection(SF_SMALL)
