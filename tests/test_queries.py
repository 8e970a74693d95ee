"""Every registered query on the smallest tables, against its statement where it has one."""

import pytest
from check import compare, duck

from gazetick.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
# Windows of 60 rows behind 99 warm-up rows leave no training sequence in so few bars.
EMPTY = {"sequences", "sequence_classifier"}


@pytest.fixture(scope="session")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    result = QUERIES[name](spark, SF)
    if name in SQL:
        assert compare(result, con, SQL[name]) is None
    else:
        assert result.count() > 0 or name in EMPTY


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
