"""Every registered query against its oracle SQL, on whole sample tables."""

import oracle
import pytest

from tidegauge.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("key", list(QUERIES))
def test_matches_oracle(spark, con, sf_dir, key):
    assert oracle.difference(QUERIES[key](spark, sf_dir), con, ORACLES[key]) is None


def test_entry_has_rows(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).limit(1).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())
