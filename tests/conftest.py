import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyloom.session import build_session  # noqa: E402
from tallyloom.sources.star import load_star  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "12g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def star(spark):
    return load_star(spark, SMALL)
