import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from gridstone.session import get_spark  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = get_spark("tests", 4, **{
        "spark__sql__warehouse__dir": str(warehouse),
        "spark__checkpoint__dir": str(tmp_path_factory.mktemp("checkpoints")),
        "spark__sql__shuffle__partitions": "4",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    if not os.path.isdir(SMALL):
        pytest.skip("test tables are not available")
    return SMALL


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
