"""Every query of the library against its SQL, on the smallest tables."""

from pathlib import Path

import pytest

from graphloom.plans import catalog
from tests.oracle import compare

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query(spark, name):
    compare(spark, name, catalog.queries()[name], catalog.oracle_sql()[name], FOLDER)


def test_each_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
