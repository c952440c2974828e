from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from hazardlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    """A new folder for each test."""
    return tempfile.mkdtemp(prefix="hazardlake-test-")


@pytest.fixture(scope="session")
def label(spark):
    """Evaluate a column function on rows; one result per row."""

    def run(rows, schema, function):
        df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)
        return [r[0] for r in df.select(function(*[df[c] for c in df.columns])).collect()]

    return run
