from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import data  # noqa: E402


@pytest.fixture(scope="session")
def hostile(spark):
    return data.hostile(spark).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return data.empty(spark)


@pytest.fixture(scope="session")
def docs(spark):
    return data.documents(spark)


@pytest.fixture(scope="session")
def texts(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
