"""Every registered query beside its SQL on the smallest tables."""

import __spark_entry__ as registered
import check
import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.connect(SF_DIR)


NAMES = sorted(name for module in registered.MODULES for name in module.QUERIES)


def test_every_query_has_its_sql():
    assert set(NAMES) <= set(registered.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    assert check.compare(spark, con, registered.queries()[name], registered.oracle_sql()[name], SF_DIR) == ""


def test_entry(spark):
    assert registered.entry(spark).count() > 1
