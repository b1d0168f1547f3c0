"""Every registered query equals its SQL on the small tables."""

import re

import pytest

import __spark_entry__ as entry
from tests.checking import connect, difference
from tests.conftest import SF

# the training-data queries have tests of their own
QUERIES = {n: q for n, q in entry.queries().items() if not re.match(r"op\d+_|pipeline$", n)}
ORACLES = {n: s for n, s in entry.oracle_sql().items() if n in QUERIES}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_entry_has_one_report_row(spark):
    assert entry.entry(spark).count() == 1


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
    assert len(ORACLES) > 0.95 * len(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert difference(df, con, ORACLES[name]) is None
    else:
        assert df.collect()
