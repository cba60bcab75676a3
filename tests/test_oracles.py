"""Every registered query against its SQL, row by row."""

import pytest

import __spark_entry__ as entry
from veildesk.checks import redaction, streams, tickets
from veildesk.checks.compare import connect, difference

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_of_the_library_has_an_oracle():
    own = {name for area in (tickets, redaction, streams) for name in area.QUERIES}
    assert own <= set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, con, name):
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
