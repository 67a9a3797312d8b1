"""Every registered query against its SQL twin."""

import pytest

from callsift import workload
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(workload.QUERIES))
def test_query_matches_sql(spark, con, name):
    assert difference(spark, con, workload.QUERIES[name], workload.SQL[name], FOLDER) is None


def test_every_query_has_sql():
    assert set(workload.QUERIES) == set(workload.SQL)
