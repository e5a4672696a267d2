"""Every registered query against its SQL, on the smallest tables."""

import pytest

from __spark_entry__ import entry
from feedloom.plans.checks import CHECKS
from oracle import connect, difference


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(CHECKS))
def test_query(spark, db, sf_dir, name):
    assert difference(spark, db, CHECKS[name].query, CHECKS[name].sql, sf_dir) is None


def test_entry(spark):
    assert entry(spark).count() == 1000
