"""A sample of registered queries against their DuckDB twins on sf0.001."""
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
NAMES = ["b14_preprocess_orders", "d15_user_features_events", "m36_tx_features_events",
         "m37_tx_features_simple_orders", "d31_anomaly_statistics", "d35_box_summary", "b9_median_fill"]


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("driver test data not available")
    c = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    exp = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp)
    cols = sorted(got.columns)
    a = got[cols].sort_values(cols).reset_index(drop=True)
    b = exp[cols].sort_values(cols).reset_index(drop=True)
    for c in cols:
        if pd.api.types.is_numeric_dtype(a[c]):
            assert np.allclose(a[c].astype(float), b[c].astype(float), equal_nan=True, rtol=0, atol=0), c
        else:
            assert (a[c].astype(str) == b[c].astype(str)).all(), c


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
