"""Queries against their SQL on the small tables."""

import pytest
from compare import difference, duck, duck_rows, spark_rows

from callpay.llm.oracle import ORACLE
from callpay.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, name):
    assert difference(spark_rows(QUERIES[name](spark, SF)), duck_rows(duck(SF), ORACLE[name])) is None
