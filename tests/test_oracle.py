"""Every query with a SQL twin gives the rows DuckDB gives."""

import pytest

import oracle
from playbill.plans import catalog_of_queries

FOLDER = "/root/testdata/sf0.001"
QUERIES = catalog_of_queries()


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_rows_agree(spark, duck, name):
    assert oracle.differences(QUERIES[name](spark, FOLDER), duck, QUERIES[name].sql) is None


def test_entry_gives_rows(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["country", "MOVIE", "SHOW"] and df.count() > 0
