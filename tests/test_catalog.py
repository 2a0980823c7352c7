"""Every registered query against its SQL twin, or for rows where there is none."""

import oracle
import pytest

from __spark_entry__ import entry
from tidemark.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"
SQL = ORACLES


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    assert oracle.differences(QUERIES[name](spark, SF), duck, SQL[name]) == []
    spark.catalog.clearCache()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0
    spark.catalog.clearCache()


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["timestamp", "symbol", "window", "avg_price", "std_price"]
    assert df.count() > 0


def test_entry_lists_all():
    from __spark_entry__ import oracle_sql, queries

    assert set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)
