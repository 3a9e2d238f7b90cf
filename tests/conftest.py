import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from kinora.session import get_spark
    s = get_spark("local[4]", shuffle_partitions=4, app_name="kinora-tests",
                  extra={"spark.driver.memory": "6g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
