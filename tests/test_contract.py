import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from rewardmill.plans import queries as catalog

SF = "/root/testdata/sf0.001"


def canonical(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype == object or str(df[c].dtype).startswith("str"):
            df[c] = df[c].map(lambda v: None if v is None or v != v else str(v))
    return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(catalog.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


#: These grow whole ensembles; the operators' own tests grow small ones.
SLOW = {"decision_model", "trained_features"}


@pytest.mark.parametrize("name", sorted(set(catalog.ORACLES) - SLOW))
def test_query_equals_sql(spark, duck, name):
    got = canonical(catalog.QUERIES[name](spark, SF).toPandas())
    pd.testing.assert_frame_equal(got, canonical(duck.sql(catalog.ORACLES[name]).df()), check_dtype=False, check_exact=True)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES) - SLOW))
def test_query_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0
