import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from goldleaf.session import local_session, run  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", app="goldleaf-tests")
    with run(session):
        yield session
    session.stop()


@pytest.fixture()
def schema(spark):
    """A fresh schema of the session catalog."""
    name = "test_layers"
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(name="rows")
def rows_fixture():
    return rows
