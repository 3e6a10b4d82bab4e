"""Every registered query at the smallest scale against its SQL; rows-only queries must run."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import check, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_sql(spark, con, name):
    ok, note = check(spark, con, SF, name, queries()[name], oracle_sql().get(name))
    assert ok, note


def test_entry(spark):
    df = entry(spark)
    assert {"scrape_id", "part", "cost", "model"} <= set(df.columns)
    assert df.count() == spark.read.parquet(f"{SF}/pages.parquet").count()


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
