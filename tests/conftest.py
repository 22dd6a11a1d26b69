from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    from rarespark.session import local_session

    session = local_session()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sensor_pdf(spark, sf):
    """Small wide table in both forms."""
    from rarespark.plans.fixtures import sensor_table

    df = sensor_table(spark, sf)
    return df, df.toPandas()
