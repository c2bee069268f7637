import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wicklake.session import spark_session  # noqa: E402

DATA = os.environ.get("WICKLAKE_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = spark_session("tests", "local[8]", {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "6g",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="wicklake-warehouse-"),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return f"{DATA}/sf0.01"
