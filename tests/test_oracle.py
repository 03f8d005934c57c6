"""Every registered query against SQL over the driver's tables."""

import os

import pytest

from checks import catalog
from checks.compare import differences, oracle

LARGER_DIR = "/root/testdata/sf0.01"
SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")


@pytest.fixture(scope="module")
def connection():
    return oracle(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    # The survey's 110 ids; variants are named after the id they belong to.
    ids = {key.split("_")[0] for key in catalog.QUERIES}
    assert len(ids) == 110 and ids <= set(catalog.QUERIES)


@pytest.mark.parametrize("key", list(catalog.QUERIES))
def test_same_rows(spark, connection, key):
    found = differences(spark, connection, key, SF_DIR)
    if found == ["no rows"]:
        # Nothing on the small tables proves nothing: use the larger ones.
        found = differences(spark, oracle(LARGER_DIR), key, LARGER_DIR)
    assert found == [], "\n".join(found)
