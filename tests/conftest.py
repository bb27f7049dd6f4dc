import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from emberscan.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        f"local[{min(8, os.cpu_count() or 2)}]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-"),
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="run-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-")
