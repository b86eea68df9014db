import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from statlake.session import build_session  # noqa: E402

TESTDATA = os.environ.get("STATLAKE_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "6g",
           "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
           "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return f"{TESTDATA}/sf0.001"
