import pytest

import __spark_entry__ as entry
from tests.oracle_compare import connect, difference


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_agrees_with_sql(spark, sf_dir, duck, name):
    df = entry.queries()[name](spark, sf_dir)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert difference(df, duck, sql) == ""


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    loadable = entry.entry(spark)
    assert loadable.columns == ["order_id", "cust_id", "score", "status", "cdc_timestamp", "cod_unique", "event_date"]
    assert loadable.count() == loadable.select("order_id").distinct().count() > 0
