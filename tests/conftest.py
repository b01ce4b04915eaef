from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = get_spark(
        "tests",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.warehouse.dir": str(root / "warehouse"),
            "spark.checkpoint.dir": str(root / "shared"),
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
        master="local[8]",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def database(spark, tmp_path):
    """A database of its own for one test."""
    import uuid

    from millrace.sinks import ensure_database

    name = f"t_{uuid.uuid4().hex[:10]}"
    ensure_database(spark, name, str(tmp_path / name))
    return name
