import pytest

from tallymark.catalogue import ORACLES, QUERIES, flagship
from tests.oracle import duck_rows, spark_rows

SF = "/root/testdata/sf0.01"


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    assert spark_rows(QUERIES[name](spark, SF)) == duck_rows(SF, ORACLES[name])


def test_flagship(spark):
    assert flagship(spark, SF).count() == 75
