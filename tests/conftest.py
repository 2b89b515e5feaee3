import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import build_session  # noqa: E402


def test_session():
    spark = build_session(
        "millrace-tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.driver.host": "127.0.0.1",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


test_session.__test__ = False


@pytest.fixture(scope="session")
def spark():
    yield test_session()
