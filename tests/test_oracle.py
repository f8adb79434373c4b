"""Every registered query against its SQL on the small tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import differences, duck

SF = "/root/testdata/sf0.001"


def test_registry():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["id", "score", "metadata"] and df.count() == 10


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, name):
    if name in oracle_sql():
        assert differences(spark, duck(SF), SF, queries()[name], oracle_sql()[name]) == []
    else:
        assert queries()[name](spark, SF).count() > 0
