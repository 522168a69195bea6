"""Every registered query against its SQL, on the supplied tables."""

import os

import pytest

from eventide.catalog.queries import CHECKS, QUERIES
from tests.compare import database, differences

FOLDER = os.environ.get("EVENTIDE_TEST_FOLDER", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


def test_every_query_has_its_sql():
    assert set(CHECKS) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, FOLDER), con, CHECKS[name]) == []


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["window_start", "window_end", "event_type", "count"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
