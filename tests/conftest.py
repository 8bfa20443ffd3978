import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        4,
        "tests",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.default.parallelism": "2",
            "spark.driver.memory": "4g",
        },
    )
    yield session
    session.stop()


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF
