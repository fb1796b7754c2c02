"""Every registered query against its SQL on the small tables, and its plan shape."""

import pytest
from conftest import SF_CHECK, SF_SMALL

import __spark_entry__ as entry_file
from catalogue.oracle import ORACLE
from catalogue.queries import QUERIES
from compare import difference, duck, duck_rows, spark_rows



@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "Python" not in plan.replace("PythonRDD", "")
    got = spark_rows(df)
    if name in ORACLE:
        assert difference(got, duck_rows(con, ORACLE[name])) is None
    assert got[1]


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_is_the_flagship(spark):
    df = entry_file.entry(spark)
    assert df.count() == 4


def test_known_numbers(spark):
    """Anchor figures worked out independently for the middle tables."""
    from catalogue.models import Models

    m = Models(spark, SF_CHECK)
    m.paid.createOrReplaceTempView("paid_anchor")
    rows = spark.sql(
        """SELECT atlas_tenant_id, count(*) AS n, count(contract_id) AS with_contract, count_if(is_paid_post_call) AS paid,
           round(sum(attributed_payment_amount_local), 2) AS amount, count_if(NOT is_window_closed) AS open
           FROM paid_anchor GROUP BY 1"""
    ).collect()
    assert {r.atlas_tenant_id: (r.n, r.with_contract, r.paid, r.amount, r.open) for r in rows} == {
        1001: (1484, 1286, 340, 22770.87, 239),
        1002: (1561, 1394, 377, 23719.93, 281),
        1003: (1520, 1310, 318, 21162.31, 250),
        1004: (1440, 1264, 342, 21431.39, 249),
    }
