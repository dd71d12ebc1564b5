import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lakeops.session import get_session

    session = get_session("local[*]", app_name="lakeops-tests", **{"spark.sql.shuffle.partitions": "8"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
