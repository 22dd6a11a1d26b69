from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from llm_cases import SCHEMA, edge_rows  # noqa: E402


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
