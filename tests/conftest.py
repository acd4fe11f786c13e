from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from eventlake.session import build_session

    session = build_session("eventlake-tests", "local[8]", {
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "6g",
        "spark.ui.enabled": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def shared(spark):
    from eventlake.session import shared_dir

    return shared_dir(spark, "test")
