"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import check
from sluice.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con(small):
    return check.connect(small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, small, name):
    status, note, _ = check.compare(spark, con, small, name, QUERIES[name], ORACLE.get(name))
    assert status in ("ok", "rows"), note


def test_registry_documents_what_it_covers():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) > 150
