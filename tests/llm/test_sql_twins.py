"""Queries that SQL can express, on the given tables, on awkward ones and on empty ones."""

import duckdb
import oracle
import pytest

from tidemark.llm import catalog

SF = "/root/testdata/sf0.01"
TABLES = ("documents", "benchmark", "conversations", "embeddings")


def over(path):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{path}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_given_tables(spark, name):
    assert oracle.differences(catalog.QUERIES[name](spark, SF), over(SF), catalog.ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_awkward_tables(spark, edge_dir, name):
    assert oracle.differences(catalog.QUERIES[name](spark, edge_dir), over(edge_dir), catalog.ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_empty_tables(spark, empty_dir, name):
    n = catalog.QUERIES[name](spark, empty_dir).count()
    assert n == (1 if name == "op2_chat_format" else 0)


NATIVE = ("op2_chat_format", "op4_weak_pii", "op5_url_ratio", "op7_prefix_decontam", "op8_systematic_mix")


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans(spark, name):
    plan = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop", "ExistingRDD"):
        assert word not in plan
