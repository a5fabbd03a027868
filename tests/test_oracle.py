"""Every registered query against its SQL, on the smallest tables."""

import __spark_entry__ as entry
import pytest
from compare import differences, duck
from winnow.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    if name in entry.oracle_sql():
        assert differences(df, con, entry.oracle_sql()[name]) == ""
    else:
        assert df.count() > 0
