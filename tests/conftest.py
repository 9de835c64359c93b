import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from reviewmill.session import build

    work = tmp_path_factory.mktemp("spark")
    session = build(
        "tests",
        **{
            "spark.master": "local[4]", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(work / "warehouse"), "spark.checkpoint.dir": str(work / "shared"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
