"""Every registered query against its SQL twin on the small tables."""

import pytest

from goldleaf.plans.compare import connect, spark_rows, twin_rows
from goldleaf.plans.queries import REGISTRY
from goldleaf.plans.twins import TWINS

SF_DIR = "/root/testdata/sf0.001"


def test_every_query_has_a_twin():
    assert set(REGISTRY) == set(TWINS)


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_twin(spark, duck, name):
    columns, wanted = twin_rows(duck, TWINS[name])
    got_columns, got = spark_rows(REGISTRY[name](spark, SF_DIR))
    assert got_columns == columns
    assert len(got) == len(wanted)
    assert got == wanted
