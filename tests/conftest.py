from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tastegraph.session import start_session

    session = start_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
