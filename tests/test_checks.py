"""Every registered query against its SQL twin."""

import pytest

from checks import ORACLES, QUERIES
from checks.compare import connect, difference


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, connection, name):
    assert name in ORACLES
    assert difference(spark, connection, name, sf_dir) is None


def test_entry(spark, sf_dir):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.queries()["device_metrics"](spark, sf_dir).count() > 0
